"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The transducer is normaliser o lexicon o acceptor:

* the normaliser has a state at the start, whose arc puts a blank sign in
  front, and one inside, whose arcs map a blank to that sign and any other
  character to itself;
* the lexicon is a trie, read from a piece's end to its start: an arc for each character, and from
  each piece's last state an arc back to the root that emits the piece; a character outside the
  vocabulary has an arc at the root that emits its bytes' pieces (or the unknown one);
* the acceptor weighs pieces.  A unigram model's has one state and the pieces' negative
  log probabilities.  A BPE model's has the last piece as state, weight 0 for
  a piece that merging leaves standing behind it, and infinity else.  Merging is a local
  matter, so a segmentation is the one that merging makes if and only if each
  pair of neighbours is; each prefix of the input then has one path of finite weight.

Composed with an input, position by position and only where weights are finite,
the tropical shortest path is the encoding; both kinds of model take the same path.
No piece goes on past a blank that follows another character, so the input is cut
there (and at line feeds, if no piece holds one beside others), and the
paths of words, with the text they decode to, are kept in a bounded memo.  The new words
of some texts are composed together, position by position, with array operations.
"""

from __future__ import annotations

import struct
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import arrow_schema, bounded_batches, held

BLANK = "▁"
NORMAL, UNKNOWN, USER, UNUSED, BYTE = 1, 2, 4, 5, 6
UNIGRAM, BPE = 1, 2
MEMO_WORDS = 400_000  # of each memo of a worker; the first ones stay, since frequent words come early
LONG_WORD = 64  # longer ones are composed alone and not kept
FRESH_PAIRS = 20_000
INFINITY = float("inf")
AT_START, INSIDE = 0, 1
ROOT = 0


def _fields(b: bytes):
    """(number, value) of each field of a serialised protocol buffer message."""
    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (b[i] & 127) << shift
            shift += 7
            i += 1
            if b[i - 1] < 128:
                return value, i

    i = 0
    while i < len(b):
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            n, i = varint(i)
            value, i = b[i : i + n], i + n
        else:
            n = 4 if kind == 5 else 8
            value, i = struct.unpack("<f" if n == 4 else "<d", b[i : i + n])[0], i + n
        yield tag >> 3, value


class Transducer:
    def __init__(self, model: bytes):
        pieces, self.kind, dummy = [], UNIGRAM, 1
        for number, value in _fields(model):
            if number == 1:
                f = dict(_fields(value))
                pieces.append((f.get(1, b"").decode(), f.get(2, 0.0), f.get(3, NORMAL)))
            elif number == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                f = dict(_fields(value))
                dummy = f.get(3, 1)
                if f.get(2) or f.get(4, 1):
                    raise ValueError("only models without a character map that keep extra blanks are supported")
        if not dummy or self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models with a blank in front are supported")
        self.id = {p: i for i, (p, _, t) in enumerate(pieces) if t in (NORMAL, USER, UNUSED)}
        self.score = {p: s for p, s, t in pieces if t in (NORMAL, USER, UNUSED)}
        self.name = [p for p, _, _ in pieces]
        self.unknown = next((i for i, (_, _, t) in enumerate(pieces) if t == UNKNOWN), 0)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == BYTE}
        self.out = [
            bytes([int(p[3:5], 16)]) if t == BYTE else p.replace(BLANK, " ").encode() if t in (NORMAL, USER, UNUSED) else b" \xe2\x81\x87 " if t == UNKNOWN else b""
            for p, _, t in pieces
        ]
        if any(BLANK in p.lstrip(BLANK) for p in self.id):
            raise ValueError("a piece goes on past a blank: words can't be encoded on their own")
        self.newline_alone = self.kind == BPE and not any("\n" in p for p in self.id if len(p) > 1)
        # merges in order of score; blanks alone come last, tie, and are merged from the left
        self.runs = {len(p) for p in self.id if p.strip(BLANK) == ""}
        words = sorted((p for p in self.id if len(p) > 1 and p.strip(BLANK)), key=lambda p: (-self.score[p], self.id[p]))
        self.rank = {p: r for r, p in enumerate(words)}
        if self.kind == BPE and len(self.runs) > 1 and max(self.score[BLANK * n] for n in self.runs if n > 1) >= min(self.score[p] for p in words):
            raise ValueError("runs of blanks must be the last merges")
        self.cuts: dict[str, tuple[str, str] | None] = {}
        self.worst = min(self.score.values(), default=0.0) - 10  # of an unknown character
        self.normaliser = {AT_START: ("", BLANK, INSIDE), INSIDE: str.maketrans({" ": BLANK})}
        self._lexicon()
        self.memo: dict[str, tuple[bytes, bytes]] = {}
        # the acceptor's weights met so far: sorted pairs with their weights, and those not yet sorted in
        self.pairs, self.pair_weights = np.empty(0, np.int64), np.empty(0)
        self.fresh: dict[int, float] = {}

    def _lexicon(self) -> None:
        """The trie: ``arcs[state][character]`` is the next state, ``emit[state]`` the piece number of the arc back to the root, or -1."""
        self.arcs: list[dict[str, int]] = [{}]
        self.emit: list[int] = [-1]
        self.pieces: list[str] = []  # by piece number; unknown characters get further numbers as they come
        self.weight: list[float] = []
        self.emitted: list[tuple[int, ...]] = []
        self.number: dict[str, int] = {}
        for piece in self.id:
            if self.kind == UNIGRAM or len(piece) == 1 or (piece in self.rank and self.last_merge(piece)):  # merging its characters gives it
                state = ROOT
                for c in reversed(piece):
                    after = self.arcs[state].get(c)
                    if after is None:
                        self.arcs[state][c] = after = len(self.arcs)
                        self.arcs.append({})
                        self.emit.append(-1)
                    state = after
                self.emit[state] = self._numbered(piece)
        # the same arcs as sorted numbers of state and character, for many words at a time
        arcs = sorted((state << 21 | ord(c), after) for state, out in enumerate(self.arcs) for c, after in out.items())
        self.arc_keys, self.arc_next = (np.array(x, np.int64) for x in zip(*arcs)) if arcs else (np.empty(0, np.int64),) * 2
        self.emits = np.array(self.emit, np.int64)

    def _numbered(self, piece: str) -> int:
        self.number[piece] = n = len(self.pieces)
        self.pieces.append(piece)
        self.weight.append(0.0 if self.kind == BPE else -self.score.get(piece, self.worst))
        self.emitted.append(self.ids_of([piece]))
        return n

    def last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two parts that merging joins last to make ``piece``; None if merging doesn't make it."""
        if piece not in self.cuts:
            parts, cut = list(piece), None
            while len(parts) > 1:
                rank, at = min((self.rank.get(a + b, len(self.rank)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank == len(self.rank):
                    cut = None
                    break
                cut = parts[at], parts[at + 1]
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.cuts[piece] = cut
        return self.cuts[piece]

    def accepted(self, last: int, piece: int) -> float:
        """The acceptor's weight of ``piece`` behind ``last`` (piece numbers; -1: nothing)."""
        if last < 0 or self.kind == UNIGRAM:
            return 0.0
        key = last << 32 | piece
        if key not in self.fresh:
            if len(self.fresh) >= FRESH_PAIRS:
                self._sort_in()
            self.fresh[key] = 0.0 if self._adjacent(self.pieces[last], self.pieces[piece]) else INFINITY
        return self.fresh[key]

    def _sort_in(self) -> None:
        keys = np.concatenate([self.pairs, np.fromiter(self.fresh, np.int64, len(self.fresh))])
        keys, first = np.unique(keys, return_index=True)
        weights = np.concatenate([self.pair_weights, np.fromiter(self.fresh.values(), float, len(self.fresh))])[first]
        self.pairs, self.pair_weights = (keys, weights) if len(keys) <= MEMO_WORDS else (np.empty(0, np.int64), np.empty(0))
        self.fresh = {}

    def _accepted_many(self, last: np.ndarray, piece: np.ndarray) -> np.ndarray:
        out = np.zeros(len(last))
        ask = np.flatnonzero(last >= 0) if self.kind == BPE else ()
        if not len(ask):
            return out
        key = last[ask] << 32 | piece[ask]
        place = np.minimum(np.searchsorted(self.pairs, key), max(len(self.pairs) - 1, 0))
        known = self.pairs[place] == key if len(self.pairs) else np.zeros(len(key), bool)
        if len(self.pairs):
            out[ask[known]] = self.pair_weights[place[known]]
        new, of = np.unique(key[~known], return_inverse=True)
        out[ask[~known]] = np.array([self.accepted(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()])[of]
        return out

    def _adjacent(self, left: str, right: str) -> bool:
        """Whether merging ``left`` + ``right`` leaves these two side by side (both are made by merging)."""
        # undo merges from the last; wherever a part of each side met, joining them must not have come before their own next merges
        end = len(self.rank)
        next_left = next_right = end
        while True:
            across = self.rank.get(left + right, end)
            if across < next_left and (across <= next_right < end or across < next_right):
                return False
            made_left, made_right = (self.rank.get(p, -1) if len(p) > 1 else -1 for p in (left, right))
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                next_left, left = made_left, self.last_merge(left)[1]
            else:
                next_right, right = made_right, self.last_merge(right)[0]

    def normalised(self, text: str, state: int = AT_START) -> str:
        """What the normaliser's arcs emit for ``text`` from a state on."""
        front = ""
        if state == AT_START:
            _, front, state = self.normaliser[AT_START]
        return front + text.translate(self.normaliser[state])

    def _single(self, c: str) -> int:
        return self.number[c] if c in self.number else self._numbered(c)

    def shortest_path(self, symbols: str) -> list[int]:
        """The piece numbers of the path of least weight for normalised ``symbols``.

        A composed state is a position, at the trie's root, with the acceptor's state; each
        position has one of finite weight (one acceptor state for unigram, one path for BPE).
        """
        reached = [(0.0, -1)]
        for end in range(1, len(symbols) + 1):
            best, choice, state, begin = INFINITY, -1, ROOT, end
            while begin and state is not None and not (self.kind == BPE and best < INFINITY):
                begin -= 1
                state = self.arcs[state].get(symbols[begin])
                piece = -1 if state is None else self.emit[state]
                if piece < 0 and begin == end - 1:  # byte fallback
                    piece = self._single(symbols[begin])
                if piece >= 0:
                    before, last = reached[begin]
                    through = before + self.weight[piece] + self.accepted(last, piece)
                    if through < best:
                        best, choice = through, piece
            reached.append((best, choice))
        out, n = [], len(symbols)
        while n:
            out.append(reached[n][1])
            n -= len(self.pieces[out[-1]])
        return out[::-1]

    def shortest_paths(self, inputs: list[str]) -> list[list[int]]:
        """``shortest_path`` of many inputs: the same arcs, all inputs at one position at a time."""
        if not inputs:
            return []
        given = np.array([len(x) for x in inputs])
        order = np.argsort(-given, kind="stable")  # those that reach a position come first
        size, first = given[order], (np.cumsum(given) - given)[order]
        code = np.frombuffer("".join(inputs).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        unknown = np.unique(code)
        single = {c: self._single(chr(c)) for c in unknown.tolist()}
        single = np.array([single[c] for c in unknown.tolist()], np.int64)[np.searchsorted(unknown, code)]
        weight, length = np.array(self.weight), np.array([len(p) for p in self.pieces])
        width, bpe = int(size[0]) if len(size) else 0, self.kind == BPE
        total, last = np.full((width + 1, len(size)), INFINITY), np.full((width + 1, len(size)), -1, np.int64)
        total[0] = 0.0
        for end in range(1, width + 1):
            live = np.arange(np.searchsorted(-size, -end, side="right"))
            state = np.zeros(len(live), np.int64)
            for begin in range(end - 1, -1, -1):
                at = first[live] + begin
                key = state << 21 | code[at]
                place = np.minimum(np.searchsorted(self.arc_keys, key), len(self.arc_keys) - 1)
                there = self.arc_keys[place] == key
                state = np.where(there, self.arc_next[place], -1)
                piece = np.where(there, self.emits[state], -1)
                if begin == end - 1:  # byte fallback
                    piece = np.where(piece < 0, single[at], piece)
                hit = np.flatnonzero(piece >= 0)
                if len(hit):
                    who, what = live[hit], piece[hit]
                    through = total[begin, who] + weight[what] + self._accepted_many(last[begin, who], what)
                    better = through < total[end, who]
                    total[end, who[better]], last[end, who[better]] = through[better], what[better]
                on = there & ~(bpe & (total[end, live] < INFINITY))
                live, state = live[on], state[on]
                if not len(live):
                    break
        steps, at, rows = [], size.copy(), np.arange(len(size))
        while len(rows):  # back along the paths, all inputs a piece at a time
            piece = last[at[rows], rows]
            steps.append((rows, piece))
            at[rows] -= length[piece]
            rows = rows[at[rows] > 0]
        pieces = np.full((len(size), len(steps)), -1, np.int64)
        for k, (rows, piece) in enumerate(reversed(steps)):
            pieces[order[rows], k] = piece
        flat, ends = pieces[pieces >= 0].tolist(), np.cumsum((pieces >= 0).sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def path(self, word: str) -> list[str]:
        """The pieces of the shortest path for normalised ``word``."""
        return [self.pieces[p] for p in self.shortest_path(word)]

    def ids_of(self, pieces: list[str]) -> tuple[int, ...]:
        out = []
        for p in pieces:
            if p in self.id:
                out.append(self.id[p])
            elif self.bytes:
                out.extend(self.bytes[b] for b in p.encode("utf-8", "replace"))
            else:
                out.append(self.unknown)
        return tuple(out)

    def blanks(self, n: int) -> list[str]:
        """A run of blanks that no word has taken, merged from the left."""
        if self.kind == UNIGRAM:
            return self.path(BLANK * n)
        out: list[int] = []
        while n:
            grown = 1  # the first symbol grows blank by blank
            while grown < n and grown + 1 in self.runs:
                grown += 1
            if grown + 1 < n and grown + 2 in self.runs and 2 in self.runs:
                grown += 2  # then takes the pair that forms behind it
            out.append(grown)
            n -= grown
        return [BLANK * k for k in out]

    def _pair(self, numbers: list[int]) -> tuple[bytes, bytes]:
        """Ids, as bytes of 32-bit integers, and the bytes they decode to."""
        ids = array("i", [i for p in numbers for i in self.emitted[p]])
        return ids.tobytes(), b"".join(map(self.out.__getitem__, ids))

    def _blanks(self, n: int) -> tuple[bytes, bytes]:
        ids = array("i", self.ids_of(self.blanks(n)))
        return ids.tobytes(), b"".join(map(self.out.__getitem__, ids))

    def cut(self, text: str) -> list[str]:
        """Words of ``text``; one that begins with a line feed has no blank in front, an empty one is a blank more."""
        text = text.replace(BLANK, " ")
        return (text.replace("\n", " \n") if self.newline_alone else text).split(" ")

    def _own_line(self, word: str) -> bool:
        return self.newline_alone and word.startswith("\n")

    def _new_words(self, new: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids, and the bytes they decode to, of words as ``cut`` gives them (each behind its blank); kept while the memo has room."""
        inputs = [self.normalised(w, INSIDE if self._own_line(w) else AT_START) for w in new]
        short = [i for i, w in enumerate(new) if len(w) <= LONG_WORD]
        paths = dict(zip(short, self.shortest_paths([inputs[i] for i in short])))
        found = {w: self._pair(paths[i] if i in paths else self.shortest_path(inputs[i])) for i, w in enumerate(new)}
        for i in short[: max(MEMO_WORDS - len(self.memo), 0)]:
            self.memo[new[i]] = found[new[i]]
        return found

    def _with_blanks(self, words: list[str], found: list[tuple[bytes, bytes] | None]) -> list[tuple[bytes, bytes]]:
        """``found`` with the runs of blanks between words, which empty words stand for."""
        out, empty = [], 0
        alone = array("i", [self.id.get(BLANK, -1)]).tobytes()
        for w, pair in zip(words, found):
            if not w:
                empty += 1
                continue
            ids, text = pair
            if not self._own_line(w) and ids[:4] == alone:  # the word hasn't taken the blank before it
                empty, ids, text = empty + 1, ids[4:], text[1:]
            if empty:
                out.append(self._blanks(empty))
            out.append((ids, text))
            empty = 0
        return [*out, self._blanks(empty)] if empty else out

    def paths(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its ids, as bytes of 32-bit integers, and the bytes that decoding them gives."""
        cut = [self.cut(t) if t else [] for t in texts]
        known = [list(map(self.memo.get, words)) for words in cut]
        missing: set[str] = set()
        for words, found in zip(cut, known):
            if None in found:
                missing.update(w for w, f in zip(words, found) if f is None)
        missing.discard("")
        new = self._new_words(list(missing)) if missing else {}
        out = []
        for words, found in zip(cut, known):
            if None in found:
                found = [f or new.get(w) for w, f in zip(words, found)]
                if None in found:
                    found = self._with_blanks(words, found)
            out.append((b"".join([p[0] for p in found]), b"".join([p[1] for p in found])))
        return out

    def encode(self, text: str) -> list[int]:
        return array("i", self.paths([text])[0][0]).tolist()

    def decode(self, ids) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, U+2581 comes back as a blank."""
        return decoded_text(b"".join(map(self.out.__getitem__, ids)))


def decoded_text(raw: bytes) -> str:
    """The text of pieces' bytes, without the blank that the normaliser put in front."""
    return raw.decode("utf-8", "replace").removeprefix(" ")


def transducer(model, token: str) -> Transducer:
    """A worker's transducer for a broadcast model."""
    return held(token, lambda: Transducer(model.value))


def read_model(path: str) -> bytes:
    """The model file, read by the driver and then broadcast (its size is that of the vocabulary)."""
    with open(path, "rb") as f:
        return f.read()


def _encoded(model, token: str, schema: pa.Schema):
    def run(batches):
        t = transducer(model, token)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, same = [], []
                texts = part.column(1).to_pylist()
                for text, (own, back) in zip(texts, t.paths(texts)):
                    plain = (text or "").replace(BLANK, " ")
                    ids.append(own)
                    same.append(back.removeprefix(b" ") == plain.encode() or decoded_text(back) == plain)
                length = np.array([len(i) // 4 for i in ids])
                flat = np.frombuffer(b"".join(ids), np.int32)
                null = part.column(1).is_null().to_numpy(zero_copy_only=False)
                offsets = pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32), mask=np.append(null, False))
                arrays = [part.column(0), pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.array(length, pa.int64()), pa.array(same)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def encoded(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids (array), n_ids, round_trip (decoding gives the text again).

    A null text has null ids, an empty one none (n_ids 0, round_trip true).
    U+2581 itself decodes to a blank, as in the library.  Rows are as many as
    before; other columns aren't read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(read_model(model_path))
    token = f"{spark.sparkContext.applicationId}-{model._jbroadcast.id()}"
    ddl = f"id {docs.schema[id_col].dataType.simpleString()}, ids array<int>, n_ids long, round_trip boolean"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_encoded(model, token, arrow_schema(ddl)), ddl).withColumnRenamed("id", id_col)


def decoded(rows: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``rows`` with the text of their ids in a column ``text_col`` (null ids: null)."""
    spark = rows.sparkSession
    model = spark.sparkContext.broadcast(read_model(model_path))
    token = f"{spark.sparkContext.applicationId}-{model._jbroadcast.id()}"

    @F.pandas_udf("string")
    def text_of(ids):
        t = transducer(model, token)
        return ids.map(lambda x: None if x is None else t.decode(x))

    return rows.withColumn(text_col, text_of(F.col(ids_col)))

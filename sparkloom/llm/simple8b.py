"""Token ids in binary files of Simple-8b blocks.

A 64-bit word is a selector (4 bits) and 60 bits of payload: the selector says
how many values of how many bits it packs.  Values of 2^60 and more are
escapes: their word's payload is a place in the block's escape area.

A file is a row of blocks, each followed by a line feed (all numbers little-endian):

    magic "S8B1", u32 part, u32 documents, u32 words, u32 escapes, u64 ids, u64 offset
    i64 document ids, u8 1 if that id isn't null, u64 ids of each document
    u64 words, u64 escapes

``offset`` counts the ids of the part before the block, so each block decodes by
itself, all words of one selector at once.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import arrow_schema, fresh_path, staged

# Fixed values: (values of a word, bits of each) by selector; selector 0 is the escape.
SELECTORS = [(1, 0), (240, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
HEAD = struct.Struct("<4sIIIIQQ")
MAGIC = b"S8B1"
BLOCK_IDS = 65_536
BLOCKS_OF_FILE = 64
MEMO_WORDS = 450_000  # of each memo of a worker; the first ones stay, since frequent words come early
# byte-level tokenizers write a byte without a visible sign as one from 256 on, in order
_unseen = [*range(33), *range(127, 161), 173]
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(_unseen)}
_powers = np.array([1 << b for b in range(64)], np.uint64)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of unsigned 64-bit values; every word takes as many values as fit."""
    n = len(values)
    values = values.astype(np.uint64)
    need = np.searchsorted(_powers, values, side="right").astype(np.int8)
    choice = np.zeros(n, np.int8)
    widest = {1: need}  # the most bits among so many values from a place on
    size = 1
    while size * 2 <= min(n, 240):
        half = widest[size]
        widest[size * 2] = np.maximum(half[: len(half) - size], half[size:])
        size *= 2
    for selector in range(len(SELECTORS) - 1, 0, -1):  # from one value a word to most; more values win
        count, bits = SELECTORS[selector]
        if count > n:
            continue
        size = 1 << (count.bit_length() - 1)
        span = n - count + 1
        most = np.maximum(widest[size][:span], widest[size][count - size : count - size + span])
        choice[:span][most <= bits] = selector
    jump = np.array([c for c, _ in SELECTORS])[choice].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += jump[at]
    begin = np.array(starts, np.int64)
    chosen = choice[begin] if n else np.empty(0, np.int8)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(chosen):
        count, bits = SELECTORS[selector]
        of = np.flatnonzero(chosen == selector)
        if selector == 0:
            words[of] |= np.arange(len(of), dtype=np.uint64)
        elif bits:
            for j in range(count):
                words[of] |= values[begin[of] + j] << np.uint64(bits * j)
    return words, values[begin[chosen == 0]] if n else values


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The values of ``pack``'s words and escapes."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([c for c, _ in SELECTORS])[chosen]
    begin = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(begin[-1], np.uint64)
    for selector in np.unique(chosen):
        count, bits = SELECTORS[selector]
        of = np.flatnonzero(chosen == selector)
        if selector == 0:
            out[begin[of]] = escapes[(words[of] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif bits:
            mask = np.uint64((1 << bits) - 1)
            for j in range(count):
                out[begin[of] + j] = words[of] >> np.uint64(bits * j) & mask
    return out


def block_bytes(part: int, offset: int, doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """A block of documents: their ``ids`` one after the other, ``counts`` of each."""
    words, escapes = pack(ids.astype(np.uint64))
    return b"".join([
        HEAD.pack(MAGIC, part, len(counts), len(words), len(escapes), len(ids), offset),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is not None for d in doc_ids),
        np.array(counts, "<u8").tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes(),
    ])


def blocks_of(content: bytes) -> Iterator[tuple[int, int, list[int | None], list[np.ndarray]]]:
    """(part, offset, document ids, their ids) of each block of a file."""
    at = 0
    while at < len(content):
        magic, part, docs, n_words, n_escapes, total, offset = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at += HEAD.size
        doc_ids = np.frombuffer(content, "<i8", docs, at).tolist()
        valid = content[at + 8 * docs : at + 9 * docs]
        at += 9 * docs
        counts = np.frombuffer(content, "<u8", docs, at).astype(np.int64)
        at += 8 * docs
        words, escapes = np.frombuffer(content, "<u8", n_words, at), np.frombuffer(content, "<u8", n_escapes, at + 8 * n_words)
        at += 8 * (n_words + n_escapes) + 1
        flat = unpack(words, escapes)
        if len(flat) != total or counts.sum() != total:
            raise ValueError("a block's ids aren't as many as it says")
        yield part, offset, [d if v else None for d, v in zip(doc_ids, valid)], np.split(flat, np.cumsum(counts)[:-1]) if docs else []
    if at != len(content):
        raise ValueError("the last block is cut short")


# The normalizer and pre-tokenizer that ``Pretokens`` stands for.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def cuts_into_words(spec: dict) -> bool:
    """Whether a tokenizer file is a BPE model of lower-case pre-tokens by ``PATTERN``, no added token of which lacks ``<|``."""
    before = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        spec["model"]["type"] == "BPE"
        and (spec.get("normalizer") or {}).get("normalizers") == NORMALIZER
        and [x["type"] for x in before] == ["Split", "ByteLevel"]
        and before[0]["pattern"] == {"Regex": PATTERN}
        and not before[1]["add_prefix_space"]
        and all("<|" in t["content"] for t in spec["added_tokens"])
    )


class Pretokens(dict):
    """Ids (as bytes of unsigned 32-bit integers) by lower-case pre-token; a missing one goes to the library's model, which merges its bytes."""

    def __init__(self, tokenizer):
        self.model = tokenizer.model

    def __missing__(self, pretoken: str) -> bytes:
        signs = pretoken if pretoken.isascii() else pretoken.encode().decode("latin-1").translate(BYTE_SIGNS)
        found = array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()
        if len(self) < MEMO_WORDS:
            self[pretoken] = found
        return found


class WordEncoder:
    """Whole texts with the tokenizers library, each different pre-token or word encoded once while a bounded memo holds it.

    Texts of ASCII and Latin-1 letters, which the normalizer only lower-cases,
    are cut into pre-tokens here.  Others are cut at blanks and line feeds,
    which no pre-token contains, and words of other letters go to the library
    as they are.  A tokenizer of another kind gets whole texts.
    """

    latin = re.compile("[\t\n\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
    # PATTERN for such texts; what begins with a letter, a digit or an apostrophe can't be the others' start
    pretoken = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[!-/:-@\\[-`{-~]+")

    def __init__(self, tokenizer_json: str, by_words: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.by_words = by_words  # see ``cuts_into_words``
        self.pretokens = Pretokens(self.tokenizer)
        self.words: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def plain(self, text: str) -> bytes | None:
        """Ids of a text that ``latin`` matches; None for others and where an added token may stand."""
        if "<|" in text or not self.latin.fullmatch(text):
            return None
        return b"".join(map(self.pretokens.__getitem__, self.pretoken.findall(text.lower())))

    def by_word(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        new = set(words).difference(self.words)
        if len(self.words) + len(new) > MEMO_WORDS:
            self.words, new = {}, set(words)
        rest = []
        for w in new:
            found = self.plain(w)
            if found is None:
                rest.append(w)
            else:
                self.words[w] = found
        for at in range(0, len(rest), 4096):
            self.words.update(zip(rest[at : at + 4096], self.whole(rest[at : at + 4096])))
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of unsigned 32-bit integers."""
        if not self.by_words:
            return self.whole(texts)
        ids = []
        for t in texts:
            found = self.plain(t)
            ids.append(self.by_word(t) if found is None else found)
        return ids


_encoders: dict[str, WordEncoder] = {}


def _written(tokenizer, token: str, by_words: bool, end_id: int):
    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if token not in _encoders:
            _encoders.clear()  # a worker holds one encoder
            _encoders[token] = WordEncoder(tokenizer.value, by_words)
        part, end, offset, doc_ids, counts, ids = TaskContext.get().partitionId(), np.uint32(end_id).tobytes(), 0, [], [], bytearray()

        def block():
            raw = block_bytes(part, offset, doc_ids, counts, np.frombuffer(bytes(ids), np.uint32))
            return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["block"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                for d, row in zip(some.column(0).to_pylist(), _encoders[token].encode([t or "" for t in some.column(1).to_pylist()])):
                    doc_ids.append(d)
                    counts.append(len(row) // 4 + 1)
                    ids += row
                    ids += end
                    if len(ids) >= 4 * BLOCK_IDS:
                        yield block()
                        offset += len(ids) // 4
                        doc_ids, counts, ids = [], [], bytearray()
        if counts:
            yield block()

    return run


def write_ids(docs: DataFrame, tokenizer_path: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every text (null: none) and ``end_id`` behind each to files in ``path``, in ascending order of id.

    Rows are dealt out by ranges of the id and, among equal or null ids, of the place they were read
    from, so a task holds a block at a time and no id is too many for one; null ids come first.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    by_words = cuts_into_words(json.loads(content))
    tokenizer = spark.sparkContext.broadcast(content)
    token = f"{spark.sparkContext.applicationId}-{tokenizer._jbroadcast.id()}"
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    blocks = rows.repartitionByRange("id", "row").sortWithinPartitions("id", "row").select("id", "text").mapInArrow(_written(tokenizer, token, by_words, end_id), "block binary")
    # the text writer puts a row's bytes as they are, on any file system that Spark reaches
    blocks.select(F.col("block").cast("string")).write.option("maxRecordsPerFile", BLOCKS_OF_FILE).text(path)


def _read(with_ids: bool, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                for part, offset, doc_ids, ids in blocks_of(content.as_buffer().to_pybytes() if content.is_valid else b""):
                    counts = np.array([len(i) for i in ids], np.int64)
                    columns = [
                        pa.array([part] * len(ids), pa.int32()),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(offset + np.cumsum(counts) - counts),
                        pa.array(counts),
                        pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files in ``path``: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers) and, if wanted, ids."""
    ddl = "part int, doc_id long, within long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    rows = staged(files.mapInArrow(_read(with_ids, arrow_schema(ddl)), ddl), "token-rows")  # one scan of the files
    # parts are as many as the write had tasks: their totals are a row each
    found = sorted((r["part"], r["n"]) for r in rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before, offsets = 0, []
    for part, n in found:
        offsets.append((part, before))
        before += n
    offsets = spark.createDataFrame(offsets, "part int, before long")
    extra = ["ids"] if with_ids else []
    return rows.join(F.broadcast(offsets), "part").select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *extra)


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids to files in the shared folder and read them back; see ``write_ids`` and ``read_ids``."""
    path = fresh_path(docs.sparkSession, "token-ids")
    write_ids(docs, tokenizer_path, path, end_id, id_col, text_col)
    return read_ids(docs.sparkSession, path)

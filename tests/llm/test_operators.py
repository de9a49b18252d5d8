"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and on odd input."""

import gc
import hashlib
import itertools
import random
import weakref
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import arcwarc, editmatch, langid, minhash, quality, queries, sharding, simple8b, surrogates, wfst, winnow
from sparkloom.llm.common import arrow_schema, components

from odd_tables import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.001"


# helpers


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40, 80)] + [(500, 500 + i) for i in range(1, 30)]
    random.Random(1).shuffle(edges)
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(40, 81), 40), **dict.fromkeys(range(500, 530), 500)}


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# 1 quality


def test_isotonic_is_the_least_squares_fit():
    x, total, ones = np.arange(6.0), np.array([1, 1, 2, 0, 1, 1.0]), np.array([0, 1, 0, 0, 1, 1.0])
    edges, levels = quality.isotonic(x, total, ones)
    assert (np.diff(levels) >= 0).all() and (np.diff(edges) > 0).all()
    at = np.interp(x, edges, levels)
    assert at[1] == pytest.approx(at[2]) and at[4] == pytest.approx(at[5]) and at[0] < at[1] < at[4]


def test_quality_on_held_out_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = queries.op1_quality(spark, "/root/testdata/sf0.01")
    assert got.count() == 1000 and got.where("score < 0 or score > 1 or score is null").count() == 0
    held = got.where("held_out").join(labels, "doc_id")
    assert held.where("predicted = quality").count() >= 0.9 * held.count()


def test_quality_odd_and_unlabelled(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_on_labels(odd_docs, none)
    assert {r[0] for r in odd_docs.select(quality.quality_of(model)("text")).collect()} == {0.5}
    assert no_docs.select(quality.quality_of(model)("text")).count() == 0
    some = spark.createDataFrame([(1, 1), (3, 0), (7, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit_on_labels(odd_docs, some)
    assert all(0 <= r[0] <= 1 for r in odd_docs.select(quality.quality_of(model)("text")).collect())


# 2 sharding


def test_differencing_beats_greedy_and_keeps_sums():
    rng = random.Random(2)
    vectors = [[rng.randint(1, 1000), *[0] * 3] for _ in range(300)]
    sums, places = sharding.difference(vectors)
    back = [0] * 4
    for v, p in zip(vectors, places):
        for x, shard in zip(v, p):
            back[shard] += x
    assert back == sums and max(sums) - min(sums) <= 4


def test_shards_are_gapless_and_even(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sharding.sharded(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    by = {}
    for r in got:
        assert r["size"] == len(r["text"].encode()) + 1 and r["text_crc32"] == zlib.crc32(r["text"].encode())
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    shard_of = {}
    for r in got:
        assert shard_of.setdefault(r["text"], r["shard"]) == r["shard"]


def test_levels_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 16)
    groups = spark.range(600).select(F.col("id").cast("string").alias("node"), (F.col("id") * 7919 % 1009 + 1).alias("weight"))
    got = groups.join(sharding.shard_of_groups(groups, 8), "node").groupBy("shard").agg(F.sum("weight").alias("w")).collect()
    assert len(got) == 8 and max(r["w"] for r in got) - min(r["w"] for r in got) < 50


def test_sharding_odd(spark, odd_docs, no_docs):
    got = sharding.sharded(odd_docs).collect()
    assert len(got) == 9 and {r["size"] for r in got if r["doc_id"] in (2, 3)} == {1}
    assert sharding.sharded(no_docs).count() == 0


# 3 archives


def test_arc_versions_parse_alike():
    records = [(1, "http://a/ b", b"x\r\n\r\nWARC/1.1"), (None, None, b"")]
    for version in (1, 2):
        content = arcwarc.arc_segment(records, version, "n.arc") + arcwarc.arc_segment(records, 3 - version, "m.arc")
        found = [(f, b) for _, f, b in arcwarc.arc_records(content) if not f["URL"].startswith("filedesc:")]
        assert [f["URL"] for f, _ in found] == ["http://a/%20b", "unknown:"] * 2
        assert [arcwarc.http_parts(b)[1] for _, b in found] == [b"x\r\n\r\nWARC/1.1", b""] * 2


def test_cut_archives_are_refused():
    content = arcwarc.arc_segment([(1, "u", b"abc")], 1, "n.arc")
    with pytest.raises(ValueError):
        list(arcwarc.arc_records(content[:-3]))


def test_warc_round_trip(spark):
    big = "x" * 1200
    rows = [(1, "u a", big), (2, None, big), (3, "u", big + "y"), (4, "u", "a\r\n\r\nWARC/1.1\r\n\n"), (5, "u", None), (6, "u", "s"), (8, "v", "s"), (9, "u", big), (None, "u", big), (7, "u", "é\0\n" * 700), (7, "u", "é\0\n" * 700)]
    got = sorted(map(tuple, arcwarc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()), key=str)
    expect = []
    for i, _, html in rows:
        raw = (html or "").encode()
        refers = 9 if html == big and i != 9 else None
        expect.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if refers else "response", refers))
    # of two equal rows one is the response
    expect[-1] = (*expect[-1][:3], "revisit", 7)
    assert got == sorted(expect, key=str)


def test_warc_of_no_pages(spark):
    assert arcwarc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# 4 SentencePiece


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    return wfst.Transducer(wfst.read_model(path)), sentencepiece.SentencePieceProcessor(model_file=path)


def test_encoding_equals_the_library(pieces):
    own, library = pieces
    rng = random.Random(5)
    stock = [" ", "  ", "a", "the", "aa", "aaaa", "\n", "ß", "é", "日本", "😩", "\t", "▁", "000", "--", "ing", "ed", "th", "==", "(", "́", "'", "http://", "</s>", "<0x0A>"]
    for _ in range(3000):
        text = "".join(rng.choice(stock) * rng.choice([1, 1, 1, 2, 3]) for _ in range(rng.randint(0, 14)))
        assert own.encode(text) == library.encode(text), text
    for n in range(70):
        assert own.encode(" " * n) == library.encode(" " * n)
    word = "".join(rng.choice("abcdefgh-.") for _ in range(3000))
    assert own.encode(word) == library.encode(word)


def test_encoding_of_documents(spark, pieces, odd_docs, no_docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = dict(map(tuple, docs.select("doc_id", "text").collect()))
    for r in wfst.encoded(docs, path).collect():
        assert r["ids"] == pieces[1].encode(texts[r["doc_id"]]) and r["round_trip"]
    got = wfst.encoded(odd_docs, path)
    assert [(r["ids"], r["n_ids"]) for r in got.where("doc_id in (2, 3)").orderBy("doc_id").collect()] == [(None, 0), ([], 0)]
    assert wfst.decoded(got, path).where("doc_id = 7").first()["text"] == "short"
    assert wfst.encoded(no_docs, path).count() == 0


# 5 surrogates


def test_surrogates(spark, odd_docs, no_docs):
    text = (
        "Ms. Jane Smith met Ms. Smith and Mr. John Smith at +1 (906) 555-8761 or 906-555-8761, a.b@mail.example.com "
        'A.B@MAIL.EXAMPLE.COM card 4904141569155865 4904 1415 6915 5865 ip 35.13.81.194 password=e3b3ed3cc8548923d6 token = "97ffa88d7c5f5655e365"'
    )
    got = surrogates.with_surrogates(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string"), count_col="n").collect()
    assert got[0]["text"] == got[1]["text"] and got[0]["n"] == 12
    new = got[0]["text"]
    for old in ("Jane", "Smith", "555-8761", "a.b@", "A.B@", "4904141569155865", "35.13.81.194", "e3b3ed3c", "97ffa88d"):
        assert old not in new
    words = new.split()
    assert words[2] == words[5] == words[9]  # the surname
    card, spaced = words[words.index("card") + 1], "".join(words[words.index("card") + 2 : words.index("ip")])
    assert card == spaced and card[0] == "4"
    digits = [int(c) for c in reversed(card)]
    assert sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    odd = surrogates.with_surrogates(odd_docs)
    assert odd.columns == odd_docs.columns and sorted(map(str, odd.collect())) == sorted(map(str, odd_docs.collect()))
    assert surrogates.with_surrogates(no_docs).count() == 0


def test_surrogates_of_whole_names(spark):
    names = {
        "Mr. McDonald": 1, "Mr. Jean-Luc Picard": 2, "Frau Anna Maria Schmidt": 3, "Mr. O'Brien": 1, "Dr. Jane Smith": 2, "MR. SMITH": 1,
        "Prof. Dr. J. R. R. Tolkien": 4, "Herrn Dr. med. Karl Lüdenscheidt": 2, "Mr. John F. Kennedy": 3, "Frau von der Leyen": 1,
        "la señora María de la Cruz": 2, "M. d’Artagnan": 1, "Mlle Noémie Lefèvre": 2, "Sr. José Núñez": 2, "Господин Иван Петров": 2,
    }
    texts = [f"so {n}'s car, then {n}." for n in names]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["text"] for r in surrogates.with_surrogates(rows).orderBy("doc_id").collect()]
    for (name, parts), new in zip(names.items(), got):
        for word in name.replace(".", " ").split()[-parts:]:
            assert len(word) == 1 or word.lower() in ("de", "la", "der") or word.lower() not in new.lower(), (name, new)
        first, second = new[3:].split("'s car, then ")
        assert first == second[:-1]
        assert len(name.split()) == len(first.split()), (name, new)  # format: as many parts, the form of address stays
        assert first.split()[0] == name.split()[0]
    assert got[0][3:].split("'s")[0].startswith("Mr. ")


def test_surrogates_of_phones_and_cards(spark):
    phones = [
        "+33 6 12 34 56 78", "06 12 34 56 78", "+33612345678", "0033 6 12 34 56 78", "+49 30 1234567", "030 1234567", "+49 (0)30 1234567", "+34 612 345 678",
        "612345678", "5551234567", "+1 (555) 123-4567", "15551234567", "+352 621 123 456",
    ]
    cards = ["7536784127813050 12", "7536784127813050", "7536 7841 2781 3050 12", "7536 7841 2781 3050 123", "7536-7841-2781-3050"]
    rows = spark.createDataFrame([(i, f"at {x}, or") for i, x in enumerate(phones + cards)], "doc_id long, text string")
    got = [r["text"][3:-4] for r in surrogates.with_surrogates(rows, count_col="n").where("n = 1").orderBy("doc_id").collect()]
    assert len(got) == len(phones + cards)
    shape = lambda x: "".join("0" if c.isdigit() else c for c in x)
    digits = lambda x: "".join(c for c in x if c.isdigit())
    for old, new in zip(phones + cards, got):
        assert old != new and shape(old) == shape(new)
    same = lambda at, n: len({digits(got[phones.index(p)])[-n:] for p in at})
    assert same(phones[:4] + ["612345678"], 9) == 1 and same(phones[4:7], 9) == 1 and same(phones[9:12], 10) == 1
    assert [g[:3] for g, p in zip(got, phones) if p[0] == "+"] == [p[:3] for p in phones if p[0] == "+"]
    assert len({digits(g)[:16] for g in got[len(phones) :]}) == 1 and [g[-3:] for g in got[len(phones) :]][0:4:2] == [" 12", " 12"] and got[-2].endswith(" 123")


def test_surrogates_of_bare_names(spark):
    text = "Smith wrote. Ms. Jane Smith and Frau Anna Maria Schmidt met; later Jane, SMITH's aunt and Maria Schmidt left, smithy and Janet stayed."
    other = "Jane Smith alone, mail a@b.example.com, Smith."
    rows = spark.createDataFrame([(1, text), (2, other)], "doc_id long, text string")
    one, two = surrogates.with_surrogates(rows, count_col="n").orderBy("doc_id").collect()
    words = one["text"].replace(";", " ").replace(",", " ").replace("'", " ").replace(".", " ").split()
    assert words[0] == words[4] and words[4] == words[13].capitalize() and words[13].isupper() and words[3] == words[12]
    assert words[8:10] == words[17:19] and words[19:] == "left smithy and Janet stayed".split()
    assert one["n"] == 2 + 5 and not {"Jane", "Smith", "Anna", "Maria", "Schmidt", "SMITH"} & set(words)
    assert two["n"] == 1 and two["text"].startswith("Jane Smith alone") and two["text"].endswith("Smith.")  # no form of address: not a detected name


def test_surrogates_stay_distinct(spark):
    # more given names than the stock has: they clash, and are drawn anew
    names = ["".join(p).capitalize() for p in itertools.product("abcde", "lmnop", "aeiou")]
    entities = spark.createDataFrame([("given_f_latin", n.lower()) for n in names], "kind string, form string")
    table = surrogates.surrogate_table(entities, "k").collect()
    made = [r["surrogate"].lower() for r in table]
    assert len(set(made)) == len(names) == len(table) and not set(made) & {r["form"] for r in table}


# 6 near duplicates


def brute_components(rows, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            label[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_texts(n=60):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(0, 7)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        out.append((i, " ".join(words)))
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_brute_force(spark, percent):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in near_texts()]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, percent)


def test_clusters_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 2000)
    rows = near_texts()
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, 85)


def test_only_keys_of_large_clusters_are_looked_at_again(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 2000)
    base = [f"u{i}" for i in range(400)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(20)]  # a cluster of several blocks
    rows += [(100 + i, " ".join([*(f"s{i // 2}w{j}" for j in range(100)), f"end{i}"])) for i in range(20)]  # pairs
    staged, seen = minhash.staged, {}

    def watched(df, label):
        seen[label] = staged(df, label)
        return seen[label]

    monkeypatch.setattr(minhash, "staged", watched)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: 0 if i < 20 else i - i % 2 for i, _ in rows}
    assert seen["left"].where("id >= 100").count() == 0 and seen["left"].count() <= 20


def test_near_duplicates_odd(spark, odd_docs, no_docs):
    got = sorted(map(str, ((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(odd_docs).collect())))
    assert got == sorted(map(str, [(1, 3, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 3, 1, False), (5, 3, 1, False), (None, 3, None, True), (6, 977, 6, True), (7, 1, 7, True)]))
    assert minhash.near_duplicates(no_docs).count() == 0
    kept = minhash.keep_one(odd_docs)
    # copies count as such whatever their ids: of ids 1, 5, 5 and null one row stays
    assert kept.columns == odd_docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 6, 7]
    some = spark.createDataFrame([(i, "a b c d e f g", x) for i, x in ((1, "p"), (None, "q"), (1, "r"), (None, "s"))], "doc_id long, text string, group string")
    assert [r["doc_id"] for r in minhash.keep_one(some).collect()] == [1]
    assert minhash.keep_one(some.where("doc_id is null")).count() == 1


# 7 languages


def test_languages_held_out(spark):
    sf = "/root/testdata/sf0.01"
    lang = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = queries.op7_langid(spark, sf).join(lang, "doc_id").where("held_out")
    assert held.where("lang_pred = lang").count() >= 0.97 * held.count()


def test_languages_odd(spark, odd_docs, no_docs):
    got = {r["doc_id"]: r for r in langid.identified(odd_docs).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (2, 3, 4))
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "und") for r in got.values())
    assert langid.identified(no_docs).count() == 0


# 8 winnowing


def brute_prints(text, k=winnow.K, window=winnow.WINDOW):
    """Positions that winnowing chooses, from the hashes of the k-grams."""
    if len(text) <= k:
        return [0] if text else []
    h = [int(winnow.fingerprint(text[i : i + k])[0][0]) for i in range(len(text) - k + 1)]
    out = []
    for i in range(max(1, len(h) - window + 1)):
        part = h[i : i + window]
        at = i + max(j for j, x in enumerate(part) if x == min(part))
        if not out or out[-1] != at:
            out.append(at)
    return out


def test_winnowing_equals_brute_force(monkeypatch):
    rng = random.Random(8)
    for n in (0, 1, 5, 12, 13, 40, 43, 44, 300):
        text = "".join(rng.choice("abé😀 ") for _ in range(n))
        assert winnow.fingerprint(text)[1].tolist() == brute_prints(text)
    assert winnow.fingerprint("a" * 100)[1].tolist() == brute_prints("a" * 100)
    text = "".join(rng.choice("abcd ") for _ in range(3000))
    whole = winnow.fingerprint(text)
    monkeypatch.setattr(winnow, "SEGMENT", 100)
    assert [x.tolist() for x in winnow.fingerprint(text)] == [x.tolist() for x in whole]


def test_neighbours(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(map(tuple, docs.select("doc_id", "text").collect()), reverse=True)
    got = {r["doc_id"]: r for r in winnow.neighbour_prints(docs).collect()}
    assert len(got) == len(rows)
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        new = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert got[i]["fingerprint"] == winnow.as_string(winnow.fingerprint(t))
        assert got[i]["edited_fingerprint"] == winnow.as_string(winnow.fingerprint(new))
    assert winnow.neighbour_prints(odd_docs).count() == 9
    assert winnow.neighbour_prints(no_docs).count() == 0
    assert winnow.neighbour_prints(docs.limit(1)).first()["near_next"] == 1.0


# 9 binary ids


def test_simple8b_round_trip():
    rng = np.random.default_rng(9)
    cases = [np.zeros(1000), np.arange(5), rng.integers(0, 50_000, 3001), rng.integers(0, 2**62, 500), np.array([2**64 - 1, 0, 2**60, 2**60 - 1], np.uint64), np.empty(0)]
    cases.append(np.concatenate([rng.integers(0, 2**b, 37) for b in range(1, 63)]))
    for values in cases:
        values = values.astype(np.uint64)
        words, escapes = simple8b.pack(values)
        assert (simple8b.unpack(words, escapes) == values).all() and len(words) <= max(len(values), 0)


def test_token_files_equal_the_library(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(4)
    stock = ["The", "the,", "İ>", "Å!", "Ÿ", "ßÿ.", "क़,", "don't", "x's", "á", "H̱", "ΑΣ", "٣", "½", "日本語", "...", '".', "<|endoftext|>", "b<|endoftext|>c", "\n", "\t", "\xa0", " ", "A.B", "e-mail", "I’m", "1234"]
    rows = [(i, "".join(rng.choice(stock) + rng.choice(["", " ", "\n"]) for _ in range(rng.randrange(30)))) for i in range(300)]
    rows += [(1000 + r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in simple8b.token_ids(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()}
    start = 0
    for i, t in sorted(rows):
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t
        start += len(ids)
    odd = simple8b.token_ids(odd_docs, path).collect()
    assert len(odd) == 9 and {r["n_tokens"] for r in odd if r["doc_id"] in (2, 3, 4)} == {1}
    assert simple8b.token_ids(no_docs, path).count() == 0


@pytest.mark.parametrize("operator", ["quality", "near_dedup", "decontaminate", "matches", "encode"])
def test_batches_of_whole_texts_are_bounded(spark, no_docs, operator):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    items = spark.createDataFrame([(1, "a passage of the benchmark")], "item_id long, text string")
    call = {
        "quality": lambda: quality.described(no_docs),
        "near_dedup": lambda: minhash.keep_one(no_docs),
        "decontaminate": lambda: editmatch.without_matches(no_docs, items),
        "matches": lambda: editmatch.benchmark_matches(no_docs, items),
        "encode": lambda: wfst.encoded(no_docs, public_tokenizers.path("piece_bpe_32k.model")),
    }[operator]

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    texts = spark.range(0, 400, 1, 1).select(F.expr("repeat('word ', 10000)").alias("text"))  # 20 MB in one task
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "64m")
        call()
        assert texts.mapInArrow(sizes, "size long").agg(F.max("size")).first()[0] <= 5 << 20
        spark.conf.set(name, "1m")  # a smaller bound of the user stays
        call()
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, before)


def test_a_worker_lets_go_of_what_another_stage_held(spark):
    model = type("Model", (), {"value": wfst.read_model(public_tokenizers.path("piece_bpe_32k.model"))})
    items = type("Items", (), {"value": [(1, "a passage of the benchmark")]})
    batch = pa.RecordBatch.from_pydict({"id": [1], "text": ["a passage of the benchmark"], "leak": [False]})
    later = {
        "quality": lambda: quality.statistics_of.func(pd.Series(["a text"])),
        "near_dedup": lambda: list(minhash._sketched(arrow_schema("id long, n long, content binary, keys array<long>"), 5, 32, 6)([batch])),
        "decontaminate": lambda: list(editmatch._flagged(items, "items", "text")([batch])),
    }
    for stage, run in later.items():
        kept = weakref.ref(wfst.transducer(model, "model"))
        assert wfst.transducer(model, "model") is kept()
        run()
        gc.collect()
        assert kept() is None, stage


# 10 decontamination


def brute_distance(item, text):
    """Fewest edits of ``item`` against any substring, by dynamic programming."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[-1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_myers_equals_dynamic_programming():
    rng = random.Random(10)
    for _ in range(200):
        item = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 80)))
        text = "".join(rng.choice("ab c") for _ in range(rng.randint(0, 120)))
        found = editmatch.myers(item, text, len(item))
        assert min((d for _, d in found), default=len(item)) == min(brute_distance(item, text), len(item))


def test_matches_equal_brute_force(spark):
    rng = random.Random(11)
    items = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(15, 130)))) for i in range(12)]
    items = [(i, editmatch.normalised(t)) for i, t in items]
    docs = []
    for d in range(120):
        _, t = rng.choice(items)
        for _ in range(rng.randrange(0, 9)):
            at = rng.randrange(len(t))
            t = t[:at] + rng.choice(["", "x", "yy"]) + t[at + rng.randrange(2) :]
        docs.append((d, "".join(rng.choice("abcdefgh ") for _ in range(60)) + " " + t.upper() + " zzz"))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in editmatch.benchmark_matches(frame, bench).orderBy(F.desc("distance")).collect()}
    expect = {}
    for d, t in docs:
        for i, item in items:
            distance = brute_distance(item, editmatch.normalised(t))
            if distance <= len(item) // editmatch.CHARS_PER_EDIT:
                expect[d, i] = distance
    assert got == expect
    kept = {r["doc_id"] for r in editmatch.without_matches(frame, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in expect}


def test_matches_odd(spark, odd_docs, no_docs, monkeypatch):
    bench = spark.createDataFrame([(1, "two three  FOUR five"), (2, None), (3, ""), (None, "one"), (4, "short")], "item_id long, text string")
    expect = [(None, 1), (1, 1), (5, 1), (5, 1), (7, 4)]
    for size in (8_000_000, 8):  # in one block, in several
        monkeypatch.setattr(editmatch, "BLOCK_CHARS", size)
        got = editmatch.benchmark_matches(odd_docs, bench)
        assert sorted(map(str, ((r["doc_id"], r["item_id"]) for r in got.collect()))) == sorted(map(str, expect))
        left = editmatch.without_matches(odd_docs, bench)
        assert left.columns == odd_docs.columns and left.count() == 4
    assert editmatch.benchmark_matches(no_docs, bench).count() == 0
    assert editmatch.without_matches(odd_docs, bench.limit(0)).count() == 9


def test_items_without_an_id_and_blocks_under_one_id(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "so the quick brown fox jumps over it"), (2, "nothing of the kind is said here")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "The quick  brown fox jumps"), (None, None)], "item_id long, text string")
    assert [r["doc_id"] for r in editmatch.without_matches(docs, bench).collect()] == [2]
    assert editmatch.benchmark_matches(docs, bench).count() == 0  # a match names its item's id
    monkeypatch.setattr(editmatch, "BLOCK_CHARS", 100)
    hot = spark.createDataFrame([(7, f"passage {i} of the one item with all texts") for i in range(40)], "item_id long, text string")
    for id_col in ("item_id", None):
        blocks = list(editmatch.item_blocks(hot.union(hot), id_col, "text"))
        assert sum(map(len, blocks)) == 40 and all(sum(len(t) for _, t in b) <= 100 for b in blocks)


def test_edited_texts_share_a_print_from_86_code_points_on():
    rnd = random.Random(8)
    text = lambda n: "".join(rnd.choices("abcdefgh ", k=n))
    for n in [*range(86, 130), 500]:
        old = text(n)
        assert winnow.likeness(*(np.unique(winnow.fingerprint(t)[0]) for t in (old, winnow.edited(old, text(n))))) > 0


# SQL


def test_arc_to_warc_as_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    columns = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    expect = con.sql(f"SELECT {columns} FROM ({queries.ORACLE_SQL['op3_arc_to_warc']})").fetchall()
    got = queries.op3_arc_to_warc(spark, SF).selectExpr(*columns.split(", ")).collect()
    assert expect and sorted(map(str, map(tuple, got))) == sorted(map(str, expect))


# 5 surrogates: long texts


def test_surrogates_of_long_repeats(spark):
    n = 100_000
    parts = [
        "a@" + "b." * n + "b", "x@" + "ab." * n + "com", "a" * n + "@", "1." * n, "1 " * n, "1-" * n, "(1) " * (n // 4), "Mr. " * (n // 10), "Mr. " + "A. " * n, "Mr. " + "Ab" * n,
        "Mr. Jane" + "-Jane" * n, "Mr. " + "von der " * (n // 10), "password=" * (n // 10), "password=" + "a" * n, "+1 " * n, "0" * n, "1234 " * (n // 5), "AKIA" * (n // 4),
        "Dr. med. " * (n // 10), "D'" * n, "token = " * (n // 10), "1.2.3." * (n // 6),
    ]
    rows = spark.createDataFrame(list(enumerate(parts)), "doc_id long, text string").repartition(len(parts), "doc_id")
    got = surrogates.with_surrogates(rows, count_col="n").collect()
    assert len(got) == len(parts) and {r["doc_id"]: r["n"] for r in got}[1] == 1


def test_order_numbers_stay(spark):
    kept = ["order 5551234567", "invoice no. 6123456789", "Rechnung Nr. 612345678", "item #9876543210", "1199999999 units", "190000000 euros"]
    found = ["call 5551234567", "at 612345678"]
    rows = spark.createDataFrame(list(enumerate(kept + found)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in surrogates.with_surrogates(rows, count_col="n").collect()}
    assert [got[i]["n"] for i in range(len(got))] == [0] * len(kept) + [1] * len(found)
    assert [got[i]["text"] for i in range(len(kept))] == kept


def scan(text):
    """Plain entities of a text by a scanner of its own: e-mail, IPv4, card with a valid Luhn sum, token in quotes."""
    import re

    out = []
    for word in re.findall(r"token = \"[0-9a-f]{16,}\"|[\w.+-]+@[\w-]+(?:\.[\w-]+)+|(?<![\w.])\d+(?:\.\d+){3}(?![\w.])|(?<![\w.])\d{16}(?!\w)", text):
        if word.startswith("token"):
            word = word[9:-1]
        elif word.isdigit():
            d = [int(c) for c in reversed(word)]
            if sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10:
                continue
        elif "@" not in word and not all(int(p) < 256 for p in word.split(".")):
            continue
        out.append(word)
    return out


def test_planted_entities_against_a_scanner(spark):
    rng = random.Random(7)
    plain = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    clean = [t for t in plain if not any(c.isdigit() or c in "@|" for c in t) and "oken" not in t][:60]
    rows, planted = [], {}
    for i, t in enumerate(clean):
        words = t.split(" ")
        own = []
        for _ in range(i % 4):
            card = [rng.randrange(1, 10), *(rng.randrange(10) for _ in range(14))]
            card.append(-sum((x * 2 - 9 * (x > 4)) if k % 2 == 0 else x for k, x in enumerate(card)) % 10)
            one = rng.choice([f"u{rng.randrange(9)}@mail{rng.randrange(9)}.example.com", "10.{}.3.{}".format(rng.randrange(99), rng.randrange(256)), "".join(map(str, card)), f'token = "{rng.randrange(16**15, 16**16):x}"'])
            own.append(one)
            words.insert(rng.randrange(len(words) + 1), one)
        planted[i] = own
        rows.append((i, " ".join(words)))
    got = surrogates.with_surrogates(spark.createDataFrame(rows, "doc_id long, text string"), count_col="n").collect()
    names: dict[str, set[str]] = {}
    for r in got:
        before, after = scan(dict(rows)[r["doc_id"]]), scan(r["text"])
        assert len(before) == len(after) == r["n"] == len(planted[r["doc_id"]])
        for a, b in zip(before, after):
            assert a != b
            names.setdefault(a, set()).add(b)
        if not before:
            assert r["text"] == dict(rows)[r["doc_id"]]
    assert all(len(x) == 1 for x in names.values()) and len({next(iter(x)) for x in names.values()}) == len(names)  # coreference, distinctness


# 1, 2, 7: brute force


def test_quality_fit_equals_a_dense_solve(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit_on_labels(docs, labels)
    y = {r["doc_id"]: r["quality"] for r in labels.collect()}
    main, held = [], []
    for r in docs.select("doc_id", "text").collect():
        if r["doc_id"] in y and zlib.crc32(str(r["doc_id"]).encode()) % 5:
            (held if zlib.crc32(f"calibrate{r['doc_id']}".encode()) % 4 == 0 else main).append((quality.statistics(r["text"]), y[r["doc_id"]]))
    x, t = np.array([a for a, _ in main]), np.array([b for _, b in main], float)
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, np.sqrt(np.maximum(x.var(0), 1e-8)))
    z = model.fourier(x)
    weights = np.linalg.solve(z.T @ z + quality.RIDGE * len(x) / quality.FEATURES * np.eye(z.shape[1]), z.T @ t)
    assert np.abs(weights - model.weights).max() < 1e-6
    # a textbook isotonic fit: the greatest lower mean of every stretch that ends here, over all stretches that start here
    raw, ones = model.raw(np.array([a for a, _ in held])), np.array([b for _, b in held], float)
    at = np.clip((raw + 0.5) / 2 * quality.BINS, 0, quality.BINS - 1).astype(int)
    used = np.unique(at)
    n, s = np.array([(at == u).sum() for u in used]), np.array([ones[at == u].sum() for u in used])
    fitted = [max(min(s[a : b + 1].sum() / n[a : b + 1].sum() for b in range(i, len(used))) for a in range(i + 1)) for i in range(len(used))]
    pools = {}
    for f, a, b in zip(fitted, n, s):
        p = pools.setdefault(round(f, 12), [0, 0])
        p[0], p[1] = p[0] + a, p[1] + b
    smooth = np.maximum.accumulate([(pools[round(f, 12)][1] + 0.5) / (pools[round(f, 12)][0] + 1) for f in fitted])
    centre = -0.5 + (used + 0.5) * 2 / quality.BINS
    assert np.allclose(np.interp(centre, model.edges, model.levels), smooth)


def test_differencing_equals_plain_karmarkar_karp():
    rng = random.Random(4)
    for shards in (2, 4):
        weights = [rng.randint(1, 10**6) for _ in range(60)]
        # the plain method: vectors with sums ascending, the two of largest spread joined in opposite order
        parts = [(tuple([0] * (shards - 1) + [w])) for w in weights]
        while len(parts) > 1:
            parts.sort(key=lambda p: p[-1] - p[0])
            a, b = parts.pop(), parts.pop()
            parts.append(tuple(sorted(x + y for x, y in zip(a, reversed(b)))))
        sums, places = sharding.difference([[w, *[0] * (shards - 1)] for w in weights])
        back = [0] * shards
        for w, p in zip(weights, places):
            back[p[0]] += w
        assert sorted(back) == sorted(sums) == list(parts[0])


def test_marked_rows_are_all_that_have_a_partner_and_few_others(spark):
    from sparkloom.llm.common import marked

    df = spark.range(20000).select(F.when(F.col("id") % 1000 != 7, F.col("id").cast("string")).alias("bits"), F.col("id").alias("n"))
    keys = df.where("n % 4 = 0").select(F.col("bits").alias("k")).union(spark.createDataFrame([(None,)], "k string"))
    got = marked(df, "bits", keys, "k", "m").collect()
    assert len(got) == 20000 and all(r["m"] for r in got if r["n"] % 4 == 0)
    assert not any(r["m"] for r in got if r["bits"] is None) and sum(r["m"] for r in got) < 5000 + 0.15 * 15000
    assert marked(df, "bits", keys.limit(0), "k", "m").where("m").count() == 0


def test_rows_in_no_group_are_not_shuffled(spark):
    from sparkloom.llm import minhash

    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(f"{w}x{i}" for w in words)) for i in range(6)] + [(9, " ".join(words)), (8, " ".join([*words, "end"])), (None, None), (None, "")]
    kept = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), percent=80)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in kept.collect()) == [-1, -1, 0, 1, 2, 3, 4, 5, 8]
    plan = kept._jdf.queryExecution().analyzed().toString()
    assert plan.count("may_be_grouped") >= 3  # the rows that pass, and the others, are told apart before the join

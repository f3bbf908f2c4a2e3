"""Operators on documents against brute force, on odd rows and on a small table."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from llm.conftest import ODD
from pyspark.sql import functions as F

from wakeline.llm import bpe, decontaminate, langid, line_dedup, quality, queries, simhash, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows_of(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def expected(rows, make):
    return sorted(map(repr, map(make, rows)))


def repeats_by_hand(texts, size):
    words = [WORD.findall(t or "") for t in texts]
    times = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if times[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), kept))
    return out


@pytest.mark.parametrize("shard_chars", [substring_dedup.SHARD_CHARS, 20_000])
@pytest.mark.parametrize("window", [35, 3, 8])
def test_substring_odd(odd, shard_chars, window):
    got = substring_dedup.remove_repeats(odd, window=window, shard_chars=shard_chars)
    want = repeats_by_hand([r[1] for r in ODD], window)
    assert sorted(map(str, (tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_text", "note").collect()))) == sorted(
        str((r[0], *w, r[5])) for r, w in zip(ODD, want, strict=True)
    )
    assert got.filter(F.sha2("kept_text", 256) != F.col("kept_sha256")).count() == 0


def test_substring_in_many_shards(lab, small):
    docs = lab.read.parquet(f"{small}/documents.parquet")
    got = substring_dedup.remove_repeats(docs, shard_chars=10_000).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    rows = docs.collect()
    want = repeats_by_hand([r.text for r in rows], 35)
    assert {r[0]: tuple(r)[1:] for r in got} == {r.doc_id: w for r, w in zip(rows, want, strict=True)}


def fingerprint_by_hand(text):
    words = WORD.findall(lower(text))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashed = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def components_by_hand(prints, most=3):
    values = np.array(prints, np.uint64)
    group = np.arange(len(values))
    for i in range(len(values)):
        near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= most)
        group[np.isin(group, group[near])] = group[near].min()
    return group


def test_simhash_odd(odd):
    prints = [fingerprint_by_hand(r[1]) for r in ODD]
    group = components_by_hand(prints)
    least = {g: min((r[0] for r, h in zip(ODD, group, strict=True) if h == g and r[0] is not None), default=None) for g in set(group)}
    got = simhash.classes(odd.withColumn("bits", F.lit("clash"))).select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0"), "component_id")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        str((r[0], f"{p:016x}", least[g])) for r, p, g in zip(ODD, prints, group, strict=True)
    )
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len(set(group))


def test_links_find_every_class(lab):
    """Random fingerprints with planted neighbours at every distance up to four."""
    random = np.random.default_rng(5)
    base = random.integers(0, 2**63, 300, dtype=np.uint64)
    values = [int(v) for v in base]
    for v in base[:200]:
        for most in (1, 2, 3, 4):
            flips = random.choice(64, most, replace=False)
            values.append(int(v) ^ sum(1 << int(b) for b in flips))
    chain = [int(base[0]) ^ ((1 << n) - 1) for n in range(0, 64, 3)]
    values = sorted(set(values + chain))
    group = components_by_hand(values)
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    from wakeline.llm.components import components

    roots = dict(components(simhash.links(lab.createDataFrame(signed, "bits long"))).collect())
    found = [roots.get(s[0], s[0]) for s in signed]
    assert len(set(zip(found, group, strict=True))) == len(set(found)) == len(set(group))


def test_a_large_group_of_near_copies_has_few_links(lab):
    """A thousand fingerprints that are nearly all within three bits of each other."""
    near = sorted({(1 << a) | (1 << b) for a in range(64) for b in range(64)})
    df = lab.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in near], "bits long")
    assert simhash.links(df).count() < 40 * len(near)


def test_fingerprints_of_a_table(lab, small):
    docs = lab.read.parquet(f"{small}/documents.parquet").collect()
    got = {r[0]: r[1:] for r in queries.REGISTRY["op3_simhash_near_dedup"](lab, small).collect()}
    prints = [fingerprint_by_hand(r.text) for r in docs]
    group = components_by_hand(prints)
    least = {g: min(r.doc_id for r, h in zip(docs, group, strict=True) if h == g) for g in set(group)}
    assert got == {r.doc_id: (f"{p:016x}", least[g]) for r, p, g in zip(docs, prints, group, strict=True)}


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ranks():
    return bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))


@pytest.mark.parametrize(("chunk", "overlap"), [(65_536, 512), (50, 20), (7, 3), (1000, 999)])
def test_bpe_odd(odd, library, chunk, overlap):
    texts = odd.filter("length(text) < 1000 OR text IS NULL") if chunk < 100 else odd
    got = bpe.encode(texts.withColumn("ids", F.lit(1)), ranks(), P.PATTERN, chunk_chars=chunk, overlap_chars=overlap)
    assert got.count() == texts.count()
    for row in got.collect():
        text = row.text or ""
        # the library is slow on one very long word
        if len(text) < 180_000:
            assert np.frombuffer(row.ids, "<u4").tolist() == library.encode_ordinary(text)
        assert row.n_tokens == len(row.ids) // 4
        assert bytes(row.decoded) == text.encode()


def test_bpe_stitches_anywhere(library):
    codec = bpe.Codec(ranks(), P.PATTERN)
    random = np.random.default_rng(3)
    pieces = ["a", " ", "  ", "\0", "\x1c", "\xa0", "\u2028", "\u00b2", "'S", "it's ", " \t", "\n", "'s", "'", "re", "12", "é", "!!", "word", " ", "漢"]
    for _ in range(400):
        text = "".join(random.choice(pieces, random.integers(1, 60)))
        chunk = int(random.integers(4, 12))
        overlap = int(random.integers(1, chunk))
        n = -(-len(text) // chunk)
        parts = [(i * chunk, text[i * chunk : (i + 1) * chunk + overlap]) for i in range(n)]
        chunks = [(s, p, codec.boundaries(p, s, i + 1 == n)) for i, (s, p) in enumerate(parts)]
        assert bpe.stitch(codec, chunks, chunk) == codec.find.findall(text)
        ids = codec.encode_text(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_bpe_of_a_table(lab, small, library):
    docs = {r.doc_id: r.text or "" for r in lab.read.parquet(f"{small}/documents.parquet").collect()}
    for row in queries.REGISTRY["op6_byte_bpe"](lab, small).collect():
        ids = library.encode_ordinary(docs[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()


def measures_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    runs = list(zip(words, words[1:], words[2:], strict=False))
    times, again = Counter(runs), [False] * len(words)
    for i, run in enumerate(runs):
        if times[run] > 1:
            again[i : i + 3] = [True] * 3
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * sum(again) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(again), failed)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_odd(lab, odd):
    labels = lab.createDataFrame([(5, 1, 0), (6, 1, 0), (7, 0, 0), (8, 1, 0), (None, 1, 0), (99, 1, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        got = quality.judge(odd.withColumn("kept", F.lit("clash")), given)
        assert got.columns.count("kept") == 1
        assert sorted(map(str, map(tuple, got.select("doc_id", *MEASURES).collect()))) == sorted(str((r[0], *measures_by_hand(r[1]))) for r in ODD)
        assert got.filter("kept IS NULL OR (kept AND base_failed)").count() == 0


def test_quality_of_a_table(lab, small):
    docs = {r.doc_id: r.text for r in lab.read.parquet(f"{small}/documents.parquet").collect()}
    got = queries.REGISTRY["op5_quality_rules"](lab, small).collect()
    assert {r.doc_id: tuple(r[m] for m in MEASURES) for r in got} == {k: measures_by_hand(t) for k, t in docs.items()}


def test_ratio_by_hand(lab):
    """The score of a text from counts of its byte runs."""
    docs = lab.createDataFrame([(i, t) for i, t in enumerate(["abcdabcd", "abcdxyz", "qqqqqq", "zz", None])], "doc_id long, text string")
    labels = lab.createDataFrame([(i, 1, 0) for i in range(5)], "doc_id long, quality int, toxic int")
    table, least = quality.fit(docs, labels)
    got = {r.doc_id: r.llr for r in quality._scored(docs, "text", table).collect()}

    def bucket(run):
        from wakeline.llm import textscan

        return int(textscan.mix(np.array([int.from_bytes(run, "little")], np.uint64))[0] >> np.uint64(48))

    for i, text in enumerate([b"abcdabcd", b"abcdxyz", b"qqqqqq", b"zz", b""]):
        runs = [bucket(text[k : k + 4]) for k in range(len(text) - 3)]
        assert got[i] == (sum(int(table[b]) for b in runs) / len(runs) / 2**20 if runs else 0)


def test_poor_documents_are_dropped_and_trusted_ones_kept(lab):
    sf = "/root/testdata/sf0.01"
    labels = lab.read.parquet(f"{sf}/labels.parquet")
    got = queries.REGISTRY["op5_quality_rules"](lab, sf).join(labels, "doc_id").filter("NOT base_failed")
    assert got.filter("quality = 0 AND kept").count() == 0
    good = got.filter("quality = 1 AND toxic = 0")
    assert good.filter("kept").count() > 0.98 * good.count()


def test_toxic_documents_are_dropped(lab):
    """Learned from one half of the labels, asked about the other."""
    sf = "/root/testdata/sf0.01"
    labels, docs = lab.read.parquet(f"{sf}/labels.parquet"), lab.read.parquet(f"{sf}/documents.parquet")
    got = quality.judge(docs.select("doc_id", "text"), labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("quality = 1 AND NOT base_failed")
    kept = {r.toxic: r["avg(CAST(kept AS INT))"] for r in got.groupBy("toxic").agg(F.expr("avg(CAST(kept AS INT))")).collect()}
    assert kept[1] < 0.3 and kept[0] > 0.9


def test_contamination_odd(lab, odd):
    items = [(1, RUN_ITEM), (2, "third LINE"), (3, None), (4, ""), (None, "one"), (5, "größe 東京"), (6, "same same same"), (1, "one")]
    bench = lab.createDataFrame(items, "item_id long, text string")
    want = {}
    for row in ODD:
        words = PLAIN.findall(lower(row[1]))
        hit, ids = set(), set()
        for item, text in items:
            own = PLAIN.findall(lower(text))
            size = min(10, len(own))
            windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
            for i in range(len(words) - size + 1 if own else 0):
                if tuple(words[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    if item is not None:
                        ids.add(str(item))
        want.setdefault(row[0], []).append((len(words), len(hit), sorted(ids)))
    for block in (decontaminate.BLOCK_CHARS, 1):
        got = {}
        for r in decontaminate.find_passages(odd.withColumn("hit_runs", F.lit(0)), bench, block_chars=block).collect():
            got.setdefault(r.doc_id, []).append((r.n_words, r.n_hit, r.item_ids))
            assert sum(x.end - x.start for x in r.hit_runs) == r.n_hit
        assert got == want
    clean = decontaminate.clean_of(odd, bench)
    assert clean.columns == odd.columns
    assert clean.count() == sum(n_hit == 0 for own in want.values() for _, n_hit, _ in own)
    assert decontaminate.clean_of(odd, bench.limit(0)).count() == odd.count()


RUN_ITEM = "W3 w4, w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"


def lines_by_hand(rows, min_lines=2, long=120):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, hashlib.md5((rows[i][1] or "").encode()).hexdigest()))
    runs, single, out = set(), set(), {}
    for i in order:
        text = rows[i][1]
        if text is None:
            out.setdefault(rows[i][0], []).append((0, 0, None))
            continue
        parts = text.split("\n")
        at = [k for k, x in enumerate(parts) if WORD.search(x)]
        gone = set()
        for k in range(len(at)):
            own = tuple(parts[p] for p in at[k : k + min_lines])
            if len(own) == min_lines:
                if own in runs:
                    gone |= set(at[k : k + min_lines])
                runs.add(own)
            if len(parts[at[k]]) >= long:
                if parts[at[k]] in single:
                    gone.add(at[k])
                single.add(parts[at[k]])
        out.setdefault(rows[i][0], []).append((len(parts), len(gone), "\n".join(x for k, x in enumerate(parts) if k not in gone)))
    return {k: sorted(v, key=str) for k, v in out.items()}


@pytest.mark.parametrize("min_lines", [1, 2, 3, 5])
def test_lines_odd(odd, min_lines):
    got = {}
    for r in line_dedup.remove_repeats(odd.withColumn("n_lines", F.lit("clash")), min_lines=min_lines).collect():
        got.setdefault(r.doc_id, []).append((r.n_lines, r.n_removed, r.kept_text))
    assert {k: sorted(v, key=str) for k, v in got.items()} == lines_by_hand(ODD, min_lines)


def test_documents_left_without_lines_go(odd):
    kept = line_dedup.without_repeats(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 6 not in ids and {1, 2, 3, 4, 5, 11} <= set(ids) and ids.count(7) == 1


def test_language_odd(lab, odd):
    train = lab.createDataFrame([("the house and the tree", "en"), ("das haus und der baum", "de"), ("", "fr"), (None, "en"), ("x", None)], "text string, lang string")
    model = langid.fit(train)
    assert model.langs == ["de", "en"]
    got = langid.predict(odd.withColumn("score", F.lit("clash")), model)
    for r in got.collect():
        letters = re.search(r"[^\W\d_]", r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert 0 <= r.score <= 1
    probe = lab.createDataFrame([("THE tree",), ("der Baum",), ("hous",), ("12 !",)], "text string")
    assert [r.lang_pred for r in langid.predict(probe, model).collect()] == ["en", "de", "en", "und"]
    nothing = langid.fit(train.limit(0))
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}


def test_unseen_words_go_back_to_shorter_runs(lab):
    model = langid.fit(lab.createDataFrame([("abab abab", "a"), ("cdcd cdcd", "b")], "text string, lang string"))
    reader = langid.Reader(model)
    assert reader.longest("abab") and len(reader.longest("ababx")) < 7
    assert reader.judge(pa.array(["xab", "dcx", None, "1 !", "ABAB"]))[0] == ["a", "b", "und", "und", "a"]


def test_language_is_found_on_held_out_texts(lab):
    sf = "/root/testdata/sf0.01"
    got = queries.REGISTRY["op2_language_id"](lab, sf).join(lab.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) > 0.98 * len(held)


def test_empty_tables(lab, none):
    bench = lab.createDataFrame([], "item_id long, text string")
    labels = lab.createDataFrame([], "doc_id long, quality int, toxic int")
    results = [
        substring_dedup.remove_repeats(none),
        simhash.classes(none),
        simhash.one_of_each(none),
        bpe.encode(none, ranks(), P.PATTERN),
        quality.judge(none, labels),
        decontaminate.find_passages(none, bench),
        line_dedup.remove_repeats(none),
        langid.predict(none, langid.fit(none)),
    ]
    assert [r.count() for r in results] == [0] * len(results)

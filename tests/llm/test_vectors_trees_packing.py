"""Whitening, Merkle manifest and packing against brute force, on odd rows and small tables."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from llm.conftest import ODD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wakeline.llm import merkle, packing, queries, whiten

# --- whitening ---------------------------------------------------------------------

VECTORS = "vec_id long, v array<float>, component int, x string"


def whitened_by_hand(x, k):
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    c = apart / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return (apart**2).sum(axis=1), c @ vectors / np.sqrt(values), values / (c * c).sum() * n


def compare(rows, x, ids, k):
    """Rows of (id, component, n, deviation, whitened, explained, error) with a computation in one place."""
    deviation, want, share = whitened_by_hand(x, k)
    assert len(rows) == len(x) * k
    by_key = {(r["vec_id"], r["component"]): r["whitened"] for r in rows}
    got = np.array([[by_key[i, c + 1] for c in range(k)] for i in ids])
    got = got * np.sign((got * want).sum(axis=0))
    assert np.abs(got - want).max() < 1e-8
    by_id = dict(zip(ids, deviation.tolist(), strict=True))
    for r in rows:
        assert (r["n"], r["deviation"]) == (len(x), by_id[r["vec_id"]])
        assert abs(r["explained"] / share[r["component"] - 1] - 1) < 1e-10
        assert r["identity_error"] < 1e-10


def test_whitening_query(lab, small):
    rows = lab.read.parquet(f"{small}/embeddings.parquet").collect()
    x = np.floor(64 * np.array([r.embedding for r in rows], float)).astype(np.int64) + 1_000_000
    got = queries.REGISTRY["op11_embedding_whitening"](lab, small)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(got.collect(), x, [r.vec_id for r in rows], 32)


def test_whitening_of_odd_rows(lab):
    rng = np.random.default_rng(1)
    good = [(i, [float(v) for v in rng.normal(i % 3, [1, 2, 3, 4, 5])], 7, "x") for i in range(40)]
    good += [(100, [0.5, 0.5, 0.5, 0.5, 0.5], 1, "y")] * 30
    bad = [
        (200, None, 1, "x"), (201, [], 1, "x"), (202, [1.0, None, 1.0, 1.0, 1.0], 1, "x"), (203, [1.0, 2.0], 1, "x"),
        (204, [1.0, float("nan"), 1.0, 1.0, 1.0], 1, "x"), (205, [1.0, float("-inf"), 1.0, 1.0, 1.0], 1, "x"),
    ]
    table = lab.createDataFrame(good + bad, VECTORS).repartition(4)
    got = whiten.whiten(table, "v", ["vec_id", "component", "x"], scale=64, shift=10)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    x = np.floor(64 * np.array([r[1] for r in good], np.float32).astype(float)).astype(np.int64) + 10
    compare(got.collect(), x, [r[0] for r in good], 5)


def test_whitening_without_variance(lab):
    for rows in ([], [(1, None, 1, "x")], [(1, [], 1, "x")], [(i, [1.0, 2.0], 1, "x") for i in range(5)]):
        assert whiten.whiten(lab.createDataFrame(rows, VECTORS), "v", ["vec_id"]).collect() == []
    flat = [(i, [float(i), 2.0 * i, 0.0], 1, "x") for i in range(9)]
    got = whiten.whiten(lab.createDataFrame(flat, VECTORS), "v", ["vec_id"]).collect()
    assert {r.component for r in got} == {1} and len(got) == 9


def test_whitening_of_huge_entries(lab):
    rows = [(i, [float(i), 1e30 * (i % 2)], 1, "x") for i in range(10)]
    got = whiten.whiten(lab.createDataFrame(rows, VECTORS), "v", ["vec_id"]).collect()
    assert len(got) >= 10 and {r.deviation for r in got} == {None}


@pytest.mark.parametrize("spectrum", ["flat", "falling", "clusters", "one large", "poor"])
def test_leading_pairs_by_filtered_passes(spectrum):
    d, k = 150, 20
    values = {
        "flat": np.linspace(2, 1, d), "falling": 0.8 ** np.arange(d), "clusters": np.repeat([9, 5, 2.0], 50) + np.arange(d)[::-1] * 1e-3,
        "one large": np.r_[1e6, np.linspace(2, 1, d - 1)], "poor": np.r_[np.linspace(9, 5, 12), np.zeros(d - 12)],
    }[spectrum]
    turn = np.linalg.qr(np.random.default_rng(3).standard_normal((d, d)))[0]
    matrix = (turn * values) @ turn.T
    widths = []

    def times(q):
        widths.append(q.shape[1])
        return matrix @ q

    found, vectors = whiten.leading(times, d, k)
    assert np.abs(found - values[:k]).max() < 1e-11 * values[0]
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-12 * values[0]
    assert max(widths) < d, "the block never was the whole space"


def test_partial_results_meet_in_a_tree(lab, monkeypatch):
    monkeypatch.setattr(whiten, "FAN_IN", 3)
    table = lab.createDataFrame([(i, [float(i), float(i * i)], 1, "x") for i in range(200)], VECTORS).repartition(20)
    rows = table.select(F.transform("v", lambda e: e.cast("long")).alias("x"))
    assert rows.rdd.getNumPartitions() == 20
    assert whiten.total(rows, whiten._counts, lambda a, b: (a[0] + b[0], [x + y for x, y in zip(a[1], b[1], strict=True)], max(a[2], b[2]))) == (
        200, [sum(range(200)), sum(i * i for i in range(200))], 199**2
    )


# --- manifest ------------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(*values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_by_hand(nodes):
    """Root and, for each node, the runs' others level by level."""
    siblings, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, members = [], []
        for a in range(0, len(nodes), 3):
            run = nodes[a : a + 3]
            for j in range(len(run)):
                for m in below[a + j]:
                    siblings[m].append((run[:j], run[j + 1 :]))
            above.append(digest(*run))
            members.append([m for own in below[a : a + 3] for m in own])
        nodes, below = above, members
    return nodes[0], siblings


def manifest_by_hand(docs):
    """(doc_id, leaf, subroot, root, proof, folded root) of rows of dicts."""
    parts = {}
    for r in docs:
        leaf = leaf_by_hand(*(r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")))
        parts.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, r))
    names = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        own = sorted(parts[name], key=lambda p: p[:3])
        trees.append((own, *tree_by_hand([p[2] for p in own])))
    root, above = tree_by_hand([t[1] for t in trees])
    for (own, subroot, paths), upper in zip(trees, above, strict=True):
        for (_, _, leaf, r), path in zip(own, paths, strict=True):
            folded, path = leaf, path + upper
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                folded = leaf_by_hand(*(r[c] for c in ("doc_id", "source", "lang", "n_chars")), r["text"].replace("\n", ""))
            for before, after in path:
                folded = digest(*before, folded, *after)
            yield (r["doc_id"], leaf, subroot, root, digest(*(x for before, after in path for x in before + after)), folded, folded == root)


def test_manifest_of_odd_rows(lab, odd, none, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.REGISTRY["op12_merkle_manifest"](lab, str(tmp_path)).collect()
    want = list(manifest_by_hand([r.asDict() for r in odd.collect()]))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_in_tiers_of_blocks(lab, levels):
    """A part with most rows, parts of one row and of a power of three, a null part."""
    sizes = {"hot": 130, "one": 1, "nine": 9, "ten": 10, None: 4, **{f"s{i}": 1 for i in range(12)}}
    rows = [{"doc_id": 1000 * k + i, "source": s, "lang": "l", "n_chars": i, "text": f"t{i}\n"} for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    docs = lab.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    leaf = merkle.leaf_of(*map(F.col, docs.columns))
    found = merkle.manifest(docs.withColumn("root", F.lit("x")), leaf, "source", "doc_id", ["doc_id", "root"], levels=levels)
    assert found.columns == ["doc_id", *merkle.NEW]
    got = {r.doc_id: (r.leaf, r.subroot, r.root, r.proof) for r in found.withColumn("proof", F.sha2(merkle.proof_text(F.col("path")), 256)).collect()}
    assert got == {w[0]: w[1:5] for w in manifest_by_hand(rows)}
    assert found.filter(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


def test_a_proof_fails_after_any_change(lab):
    docs = lab.createDataFrame([(i, "s", f"text {i}") for i in range(30)], "doc_id long, source string, text string")
    found = merkle.manifest(docs, merkle.leaf_of(F.col("doc_id"), F.col("text")), "source", "doc_id", ["doc_id", "text"])
    changed = merkle.leaf_of(F.col("doc_id"), F.concat("text", F.lit(" ")))
    assert found.filter(merkle.fold(changed, F.col("path")) == F.col("root")).count() == 0


def test_manifest_of_nothing(none):
    assert merkle.manifest(none, merkle.leaf_of(F.col("text")), "source", "doc_id", ["doc_id"]).collect() == []


def test_manifest_never_shuffles_texts_nor_joins_proofs(lab, small):
    plan = queries.REGISTRY["op12_merkle_manifest"](lab, small)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "documents.parquet" not in plan


# --- packing ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def pieces_by_hand(doc_id, text, tokenizer, size=2048):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    ends = list(range(len(ids), 0, -size))[::-1]
    for i, end in enumerate(ends):
        start = ends[i - 1] if i else 0
        yield doc_id, i, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())


MORE = [(50, " " * 1_200_000 + "end", None, None, None, None), (51, "a<|endoftext|>b <|endoftext|>", None, None, None, None)]


def test_pieces_are_those_of_the_library(lab, odd, vocabulary):
    tokenizer = Tokenizer.from_str(vocabulary)
    docs = odd.union(lab.createDataFrame(MORE, odd.schema)).withColumn("start", F.lit("x"))
    got = packing.pieces(docs, vocabulary, P.PATTERN, keep=["doc_id", "start"])
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = [p for r in [*ODD, *MORE] for p in pieces_by_hand(r[0], r[1], tokenizer)]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def check_packed(rows, size):
    """Whole, without gaps; the number of sequences."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= size
    return len(sequences)


def test_packing_query(lab, small, vocabulary):
    tokenizer = Tokenizer.from_str(vocabulary)
    got = queries.REGISTRY["op13_best_fit_packing"](lab, small).collect()
    docs = lab.read.parquet(f"{small}/documents.parquet").collect()
    want = [p for r in docs for p in pieces_by_hand(r.doc_id, r.text, tokenizer)]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    least = -(-sum(p[3] for p in want) // 2048)
    assert check_packed(got, 2048) <= least * 1.01 + 1


@pytest.mark.parametrize("lot", [7, 100, 100_000])
@pytest.mark.parametrize("kind", ["even", "small", "halves", "large", "same"])
def test_packing_in_rounds(lab, kind, lot):
    rng = np.random.default_rng(5)
    lengths = {
        "even": rng.integers(1, 101, 600), "small": rng.integers(1, 9, 600), "halves": np.where(np.arange(600) % 2, 60, 40),
        "large": rng.integers(51, 101, 600), "same": np.full(600, 60),
    }[kind]
    runs = lab.createDataFrame([(i, int(n), "x", 5) for i, n in enumerate(lengths)], "id int, length long, note string, offset int").repartition(30)
    found = packing.pack(runs, size=100, lot=lot)
    assert found.columns == ["id", "length", "note", "sequence_id", "offset"]
    rows = found.collect()
    assert sorted((r.id, r.length) for r in rows) == [(i, int(n)) for i, n in enumerate(lengths)]
    best = len(packing.best_fit(lengths, 100))
    assert check_packed(rows, 100) <= (best if lot > 600 else best * 1.25 + 1)


def test_best_fit_by_hand():
    assert packing.best_fit(np.array([3, 9, 6, 1, 4, 7]), 10) == [[1, 3], [5, 0], [2, 4]]
    assert packing.best_fit(np.array([], np.int64), 10) == []


def test_packing_of_nothing(lab, none, vocabulary):
    cut = packing.pieces(none, vocabulary, P.PATTERN)
    assert packing.pack(cut).collect() == []


def test_equal_rows_are_packed_each(lab):
    runs = lab.createDataFrame([(1, 40)] * 10, "id int, length long")
    rows = packing.pack(runs, size=100).collect()
    assert len(rows) == 10 and check_packed(rows, 100) == 5

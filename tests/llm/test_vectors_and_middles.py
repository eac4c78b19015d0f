"""Vector codes, nearest neighbours and fill-in-the-middle against SQL and plain Python."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from tests.conftest import SF, same
from tests.llm.helpers import awkward, clashing, written

from tideframe.llm import op11_vector_codes as codes
from tideframe.llm import op12_neighbours as near
from tideframe.llm import op13_fill_in_middle as middle

VECTORS = "vec_id long, embedding array<double>, label int"


# --- fill in the middle


def plain_middle(doc_id, text):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(tokens), "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < 20 else "psm"
    return doc_id, len(tokens), form, len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"), sha(text)


def key(row):
    return tuple(str(v) for v in row)


def test_middles_are_as_sql_says(spark, duck):
    same(middle.op13_fill_in_middle(spark, SF), duck.sql(middle.ORACLE_SQL))


def test_middles_of_awkward_rows(spark):
    more = [(100 + i, t, "en", "s", 1) for i, t in enumerate(["<P>", "a<S>b", "<", "<P", "x<M", "ab" * 4000, "\n\n", "éé abc ÿz", "𝒳y𝒳", "a1b2", "Straße " * 50, "<<S", ">S<P" * 9])]
    docs = awkward(spark).union(spark.createDataFrame(more, awkward(spark).schema))
    rows = docs.collect()
    wanted = sorted((key(plain_middle(r["doc_id"], r["text"])) for r in rows))
    assert sorted(key(r) for r in middle.digests(clashing(docs)).collect()) == wanted
    back = middle.restored(middle.transform(docs)).select("text", "restored").collect()
    assert len(back) == len(rows) and all(r["text"] == r["restored"] for r in back)


def test_middles_of_an_empty_table(spark, tmp_path):
    assert middle.op13_fill_in_middle(spark, written(awkward(spark).where("false"), tmp_path)).count() == 0


def test_wavelet_ranks_are_counts():
    rng = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 1000):
        values = rng.integers(0, 5, n).astype(np.uint8)
        matrix, places = middle.WaveletMatrix(values), np.arange(n + 1)
        for c in range(5):
            assert matrix.rank(c, places).tolist() == [int((values[:i] == c).sum()) for i in places]


# --- vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Lloyd's rounds with full scans in Python integers."""
    good = [r for r in rows if r[1] and all(v is not None and np.isfinite(v) for v in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(good[0][1])
    good = [r for r in good if len(r[1]) == dim]
    x = [[int(np.floor(v * 4096.0)) for v in r[1]] for r in good]
    width = dim // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for v in x[:entries]] for p in range(parts)]
    far = lambda a, b: sum((i - j) ** 2 for i, j in zip(a, b, strict=True))
    nearest = lambda v, p: min((far(cut(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        told = [[nearest(v, p)[1] for p in range(parts)] for v in x]
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [cut(v, p) for v, t in zip(x, told, strict=True) if t[p] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    told = [[nearest(v, p) for p in range(parts)] for v in x]
    flat = ",".join(str(v) for b in books for e in b for v in e)
    found = [(r[0], r[2], "".join(f"{k:02x}" for _, k in t), sum(d for d, _ in t)) for r, t in zip(good, told, strict=True)]
    held = lambda v: v if v < 1 << 63 else None
    return [(i, c, held(e), held(sum(f[3] for f in found if f[1] == label))) for i, label, c, e in found], hashlib.sha256(flat.encode()).hexdigest()


def coded(df):
    found = codes.encode(df)
    rows = codes.with_label_error(found.rows).select("vec_id", codes.code_text(), "error", "label_error")
    return sorted(key(r) for r in rows.collect()), codes.codebook_digest(found.codebooks)


def test_codes_are_as_sql_says(spark, duck):
    same(codes.op11_vector_codes(spark, SF), duck.sql(codes.ORACLE_SQL))


@pytest.mark.parametrize("size", [1.0, 7e4, 1e6])
def test_codes_of_awkward_rows(spark, size):
    rng = np.random.default_rng(5)
    rows = [(int(i % 50), (rng.standard_normal(16) * size).tolist(), [1, 2, None][i % 3]) for i in range(120)]
    rows += [(3, [0.5] * 16, 1)] * 3 + [(None, [0.25] * 16, None), (900, None, 1), (901, [], 1), (902, [None] + [0.0] * 15, 1), (903, [float("nan")] * 16, 1), (904, [float("inf")] + [0.0] * 15, 1), (905, [1.0] * 8, 1), (906, [0.0] * 16, 2)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    wanted, digest = plain_codes([tuple(r) for r in rows])
    assert coded(df.selectExpr("*", "1 AS state", "'x' AS kind", "0 AS entry")) == (sorted(key(r) for r in wanted), digest)


def test_codes_of_few_or_no_rows(spark):
    rows = [(1, [0.1] * 8, 1), (2, [0.7] * 8, 1)]
    wanted, digest = plain_codes(rows)
    assert coded(spark.createDataFrame(rows, VECTORS)) == (sorted(key(r) for r in wanted), digest)
    assert coded(spark.createDataFrame([], VECTORS))[0] == []
    with pytest.raises(ValueError, match="equal parts"):
        codes.encode(spark.createDataFrame([(1, [0.1] * 9, 1)], VECTORS))


def test_net_moves_save_scans_and_change_nothing():
    """An entry that moves out and back is bounded by its net move, so nothing is scanned again."""
    rng = np.random.default_rng(7)
    book = rng.integers(-4000, 4000, (16, 8))
    x = np.repeat(book, 20, axis=0) + rng.integers(-200, 200, (320, 8))
    state, history, scanned = np.zeros(320, codes.STATE), [book], []

    class Counted(codes.Bounds):
        def scan(self, x, state, rows):
            scanned.append(len(rows))
            super().scan(x, state, rows)

    Counted(history).scan(x, state, np.arange(320))
    history += [book + 3000 * (np.arange(16)[:, None] == 0), book]
    Counted(history).assign(x, state)
    assert scanned == [320] and state["entry"].tolist() == np.repeat(np.arange(16), 20).tolist()
    for t in range(5):
        history.append(history[-1] + rng.integers(-300, 300, book.shape))
        Counted(history).assign(x, state)
        full = ((x[:, None] - history[-1][None]) ** 2).sum(axis=2)
        assert state["entry"].tolist() == full.argmin(axis=1).tolist()


# --- nearest neighbours


def brute(rows, queries, top=20):
    good = [(i, np.array(v, float)) for i, v, _ in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    found = {}
    for q, v in good:
        if q is None or q not in queries:
            continue
        others = [(-float(sum(a * b for a, b in zip(v, x, strict=True))), -1 if i is None else i) for i, x in good if len(x) == len(v)]
        others.remove(next(o for o in sorted(others) if o[1] == q))
        found.setdefault(q, []).append(sorted(others)[:top])
    return found


def neighbours(df, queries, **more):
    given = df.where(df["vec_id"].isin(queries))
    rows = near.search(near.build(df), given, **more).collect()
    return {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows}, len(rows)


def test_neighbours_are_those_of_brute_force(spark, duck):
    told = near.op12_neighbours(spark, SF).toPandas()
    vectors = duck.sql("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").df()
    x, ids = np.stack(vectors["embedding"]).astype(float), vectors["vec_id"].to_numpy()
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        mine = told[told["query_id"] == ids[i]].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21)) and ids[i] not in set(mine["vec_id"])
        assert np.allclose(mine["score"], [scores[ids == v][0] for v in mine["vec_id"]]) and (np.diff(mine["score"]) <= 0).all()
        hits += len(set(mine["vec_id"]) & set(ids[np.lexsort((ids, -scores))[:20]]))
    assert hits / len(told) >= 0.97


def test_neighbours_of_awkward_rows(spark):
    rng = np.random.default_rng(11)
    rows = [(i, (rng.standard_normal(8) * 10.0 ** rng.integers(-1, 2)).tolist(), 0) for i in range(150)]
    rows += [(200 + i, [1.0] * 8, 0) for i in range(60)]  # copies: more than are asked for
    rows += [(300, None, 0), (301, [0.0] * 8, 0), (302, [None] + [1.0] * 7, 0), (303, [float("nan")] * 8, 0), (304, [], 0), (None, [0.3] * 8, 0), (400, [1.0, 2.0], 0), (401, [2.0, 1.0], 0), (402, [2.0, 1.0], 0)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS node", "2 AS q", "'x' AS code", "0 AS score")
    queries = [0, 20, 40, 60, 200, 259, 300, 301, 302, 303, 304, 400]
    wanted = brute(rows, set(queries))
    told, n = neighbours(df, queries)
    assert n == sum(len(w) for found in wanted.values() for w in found) and {q for q, _ in told} == set(wanted)
    for q, (best,) in wanted.items():
        for rank, (minus, vec_id) in enumerate(best, 1):
            found = told[q, rank]
            assert (-1 if found[0] is None else found[0]) == vec_id and found[1] == pytest.approx(-minus, rel=1e-12)


def test_neighbours_of_repeated_query_rows_and_of_nothing(spark):
    rows = [(20, [1.0, 0.0], 0), (20, [1.0, 0.0], 0), (1, [0.5, 0.5], 0)]
    df = spark.createDataFrame(rows, VECTORS)
    found = sorted(tuple(r) for r in near.search(near.build(df), df.where("vec_id = 20")).collect())
    assert found == [(20, 1, 20, 1.0)] * 2 + [(20, 2, 1, 0.5)] * 2
    assert near.search(near.build(df.where("false")), df.where("false")).count() == 0
    only = df.where("vec_id = 1")
    assert near.search(near.build(only), only).count() == 0


def test_runs_are_never_apart():
    import pyarrow as pa

    values = np.sort(np.random.default_rng(2).integers(0, 40, 500))
    for size in (1, 7, 100, 500):
        batches = [pa.RecordBatch.from_arrays([pa.array(values[i : i + size])], names=["k"]) for i in range(0, 500, size)]
        tables = [t.column("k").to_numpy() for t in near.whole_runs(iter(batches), "k")]
        assert np.concatenate(tables).tolist() == values.tolist() and all(a[-1] != b[0] for a, b in zip(tables, tables[1:], strict=False))

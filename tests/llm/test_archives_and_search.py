import hashlib
from collections import Counter

import numpy as np
import pytest

from sluicebox.llm import topk, warc
from sluicebox.llm.common import fresh_path

BIG = "<p>" + "ä" * 600 + "</p>"
PAGES = [
    (1, "http://a/x", BIG), (2, "http://a/y", BIG), (2, "http://a/y", BIG), (3, None, BIG), (4, "http://b/\r\nX: y é", "short"),
    (5, "http://b/2", "short"), (6, None, None), (7, "", ""), (None, "http://n", BIG), (8, "u", "x" * 300_000), (9, "u", "a\r\n\r\nb" * 300),
]


def pages(spark, rows):
    df = spark.createDataFrame([(i, u, h, 1, "z") for i, u, h in rows], "page_id long, url string, html string, offset int, file string")
    return df


def test_round_trip(spark):
    found = warc.round_trip(pages(spark, PAGES), spark).collect()
    expected = Counter()
    for i, _, h in PAGES:
        data = (h or "").encode()
        keeper = max((j for j, _, g in PAGES if g == h and j is not None), default=None) if len(data) >= 1000 else None
        revisit = keeper is not None and keeper != i
        expected[(i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == expected
    assert {r.url for r in found if r.page_id == 4} == {"http://b/%0D%0AX:%20y%20é"}


def test_selected_records_are_read_by_joined_ranges(spark):
    folder = fresh_path(spark, "warc")
    index = warc.write_archives(pages(spark, PAGES), folder, archive_bytes=2000)
    assert index.select("file").distinct().count() > 1
    rows = index.collect()
    for gap in (0, 10_000):
        some = index.where("page_id in (1, 4, 9)")
        found = warc.read_records(some, folder, gap_bytes=gap, read_bytes=3000).collect()
        assert sorted(r.page_id for r in found) == [1, 4, 9]
    by_file = {}
    for r in sorted(rows, key=lambda r: (r.file, r.offset)):
        assert r.offset == by_file.get(r.file, 0)
        by_file[r.file] = r.offset + r.length


def test_tasks_follow_the_bytes_to_read(spark):
    """Few index rows of long payloads are read by as many tasks as their bytes need."""
    rng = np.random.default_rng(1)
    rows = [(i, "u", rng.integers(0, 16, 400_000).astype("uint8").tobytes().hex()) for i in range(20)]
    folder = fresh_path(spark, "warc")
    index = warc.write_archives(pages(spark, rows), folder)
    size = sum(r.length for r in index.collect())
    read = warc.read_records(index, folder, read_bytes=200_000, task_bytes=500_000)
    assert read.rdd.getNumPartitions() == -(-size // 500_000) > 4
    assert {(r.page_id, r.payload_bytes) for r in read.collect()} == {(i, 800_000) for i in range(20)}


def test_a_damaged_record_is_noticed():
    data = warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), "2024-01-01T00:00:00Z", None, False)
    assert warc.parsed(data)[2:5] == (7, hashlib.sha1(b"payload").hexdigest(), "response")
    try:
        warc.parsed(data.replace(b"payload\r\n", b"paylOad\r\n"))
    except ValueError:
        return
    raise AssertionError("damage passed")


def test_no_pages(spark):
    assert warc.round_trip(pages(spark, []), spark).collect() == []


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "s") for i, v in rows], "vec_id long, embedding array<float>, rank int, score string")


def brute(rows, asked, k):
    z = [(i, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows
         if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, zq in {i: v for i, v in z if i in asked}.items():
        scores = sorted((-sum(int(a) * int(b) for a, b in zip(zq, v)), i) for i, v in z if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(12).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)]
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 12), (403, [float("inf")] * 12), (404, []), (405, [0.5]),
             (None, [1.0] * 12), (7, rows[7][1])]
    asked = {0, 5, 100, 400, 404, 405, 1000}
    df = vectors(spark, rows)
    for k, block in ((10, 64), (3, 10_000), (1000, 100)):
        found = topk.top_k(df, df.where(df["vec_id"].isin(*asked)), k=k, block_rows=block, query_rows=2).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == brute(rows, asked, k)


def test_top_k_of_few_rows(spark):
    df = vectors(spark, [(0, [1.0, 2.0])])
    assert topk.top_k(df, df).collect() == []
    assert topk.top_k(df.where("false"), df.where("false")).collect() == []


def test_search_stops_on_proof_only():
    """Blocks give the true best even where quantised scores order them otherwise."""
    import pandas as pd

    rng = np.random.default_rng(1)
    z = rng.integers(-900, 900, (500, 6))
    row = topk._index(6, 4)(pd.DataFrame({"vec_id": np.arange(500), "z": list(z), "block": 0})).iloc[0]
    block = topk.Block(row, 6, 4)
    for _ in range(50):
        query = rng.integers(-900, 900, 6)
        ids, scores = block.search(query, -1, 7, -np.inf)
        exact = z @ query
        assert scores.tolist() == sorted(exact, reverse=True)[:7] and (exact[ids] == scores).all()


@pytest.mark.parametrize("copies", [2, 20])
def test_top_k_of_repeated_query_ids(spark, copies):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(400)]
    rows += [(i, (np.array(rows[i][1]) * (1 + n % 3)).tolist()) for i in (7, 9, 30) for n in range(copies - 1)]
    df = vectors(spark, rows)
    # `brute` asks the last row of an id
    asked = vectors(spark, [(i, dict(rows)[i]) for i in (7, 9, 30)])
    for block in (64, 10_000):
        found = topk.top_k(df, asked, k=10, block_rows=block).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == brute(rows, {7, 9, 30}, 10)

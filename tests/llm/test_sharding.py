import zlib

import pytest

from tarnwork.llm.sharding import balanced_shards, op9_sharding


def brute(rows, n, overhead=16):
    keyed = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        keyed.append((doc_id is not None, doc_id or 0, zlib.crc32(raw), len(raw) + overhead, doc_id))
    keyed.sort(key=lambda r: r[:4])
    total, before, out, slots = sum(r[3] for r in keyed), 0, [], {}
    for _, _, crc, size, doc_id in keyed:
        shard = min(n - 1, (2 * before + size) * n // (2 * total))
        out.append((doc_id, size, crc, shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
        before += size
    return out


CASES = {
    "plain": [(i, "x" * (i * 37 % 90)) for i in range(200)],
    "nulls, ties and copies": [(None, None), (None, "é"), (3, "a"), (3, "a"), (3, None), (1, ""), (2, "b")] * 4,
    "one very long": [(1, "a"), (2, "ü" * 50_000), (3, "b"), (4, "c")],
    "empty": [],
}


@pytest.mark.parametrize("case", CASES)
def test_against_brute_force(frame, case):
    rows = CASES[case]
    found = balanced_shards(frame([(*r, 7, "x") for r in rows], "doc_id long, text string, shard int, rank string"), 7)
    key = lambda r: (r[0] is not None, *[(x is not None, x) for x in r])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute(rows, 7), key=key)


def test_shards_are_near_equal_over_all_documents(spark, sf_dir):
    rows = op9_sharding(spark, sf_dir).collect()
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert sorted((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in rows) == sorted(brute([tuple(d) for d in documents], 40))


def test_refuses_no_shards(frame):
    with pytest.raises(ValueError):
        balanced_shards(frame([], "doc_id long, text string"), 0)

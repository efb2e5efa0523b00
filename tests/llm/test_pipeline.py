"""The pipeline over a small table of documents, stage by stage."""

import os

import pytest

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    pytest.importorskip("public_tokenizers")
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    import corpus_pipeline as p
    from test_operators import brute_links, brute_overlap, brute_pii, brute_stats

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    quality = p.quality(spark, docs, SF)
    got = {r["doc_id"] for r in quality.collect()}
    stats = {d: brute_stats(t) for d, t in rows.items()}
    # lines are too few here to deplete a document
    assert got == {d for d, s in stats.items() if s[0] >= 50 and 100 * s[4] <= 50 * s[0]}
    near = p.near_duplicates(spark, quality, SF)
    ids = sorted(got)
    links = brute_links([rows[d] for d in ids])
    parent = dict(zip(ids, ids))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in links:
        parent[find(ids[i])] = find(ids[j])
    left = [r["doc_id"] for r in near.collect()]
    assert sorted(map(find, left)) == sorted({find(d) for d in ids})
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = p.decontamination(spark, near, SF)
    kept = {r["doc_id"] for r in clean.collect()}
    assert kept == {d for d in left if not any(brute_overlap(rows[d], x) for x in items)}
    private = p.personal_data(spark, clean, SF)
    for r in private.collect():
        assert not brute_pii(r["text"]) and r["n_chars"] == len(r["text"])
        assert brute_pii(rows[r["doc_id"]]) or r["text"] == rows[r["doc_id"]]
    assert private.columns == docs.columns
    assert p.run(spark, SF).count() == len(kept)

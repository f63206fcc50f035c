"""The pipeline stage by stage: each one's rows against what plain Python keeps of its input."""

import brute
import duckdb
from compare import DATA

import corpus_pipeline
from talkweave.llm.common import load, written

SF = "sf0.001"


def test_stages(spark):
    folder = str(DATA / SF)
    docs = load(spark, folder, "documents")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen = [docs.collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, folder), f"stage-{i}")
        assert docs.columns == columns or i == 4, name
        seen.append(docs.collect())
    first, spoken, unique, clean, mixed, sharded = seen
    assert {r.doc_id for r in spoken} >= {r.doc_id for r in first if any(c.isalpha() for c in r.text or "")}
    kept = brute.components([(r.doc_id, brute.fingerprint(r.text)) for r in spoken])
    assert sorted(r.doc_id for r in unique) == sorted(set(kept.values()))
    items = duckdb.sql(f"SELECT item_id, text FROM '{DATA / SF / 'benchmark.parquet'}'").fetchall()
    hits = brute.contamination([(r.doc_id, r.text) for r in unique], items)
    assert sorted(r.doc_id for r in clean) == sorted(k for k, (n, h, _) in hits.items() if not (h and 20 * h >= n))
    assert len(clean) < len(unique) < len(first)
    want = brute.mix([(r.doc_id, r.source, r.text) for r in clean])
    words = lambda rows: sum(len(brute.WORD.findall(r.text or "")) for r in rows)
    assert abs(words(mixed) - sum(t for _, t in want.values())) < 0.2 * words(mixed)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in clean}
    assert sorted(map(str, (r[:5] for r in sharded))) == sorted(map(str, (r[:5] for r in mixed)))
    sizes = [sum(r.shard == s for r in sharded) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1


def test_run_gives_all_rows_of_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, str(DATA / SF)).select("doc_id", "shard", "slot").collect()
    assert len({(r.shard, r.slot) for r in rows}) == len(rows) > 100

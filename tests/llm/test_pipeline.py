"""The pipeline, stage after stage, against plain versions on the small table."""

import base64

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from aerolens.llm import queries
from test_scans import expected_hits
from test_similarity import expected_groups, expected_lines

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stored(spark, frame, folder):
    frame.write.parquet(folder)
    return spark.read.parquet(folder)


def test_every_stage(spark, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "language ID", "line dedup", "MinHash near-dedup", "benchmark decontamination", "byte-level BPE"
    ]
    junk = [(900_001, None, "en", "s", None), (900_002, "12 + 34 = 46", None, "s", 12), (900_003, "", "de", None, 0)]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(junk, docs.schema))
    frames = {}
    for k, (name, stage) in enumerate(stages.items()):
        frames[name] = docs = stored(spark, stage(spark, docs, SF), str(tmp_path / str(k)))
        if name != "byte-level BPE":
            assert docs.columns == COLUMNS
    texts = {name: {r["doc_id"]: r["text"] for r in f.collect()} for name, f in frames.items() if "text" in f.columns}
    first = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}

    kept = texts["language ID"]
    assert kept.items() <= first.items() and len(kept) >= len(first) - 2

    gone = expected_lines(list(kept.items()))
    left = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in set(gone[i])) for i, t in kept.items()}
    left = {i: t for i, t in left.items() if not gone[i] or t.strip()}
    assert texts["line dedup"] == left and sum(map(len, gone.values())) > 20
    assert frames["line dedup"].where(F.col("n_chars") != F.length("text")).count() == 0

    groups = expected_groups(list(left.items()), 5, 80)
    assert set(texts["MinHash near-dedup"]) == {i for i, x in groups.items() if x[2]}

    bench = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    hits = expected_hits(list(texts["MinHash near-dedup"].items()), [(str(r[0]), r[1]) for r in bench])
    assert set(texts["benchmark decontamination"]) == {i for i, x in hits.items() if not x[3]}

    with open(public_tokenizers.path(queries.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    code = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in frames["byte-level BPE"].collect()}
    assert set(got) == set(texts["benchmark decontamination"])
    for i, text in texts["benchmark decontamination"].items():
        assert got[i]["ids"] == code.encode_ordinary(text) and got[i]["n_tokens"] == len(got[i]["ids"])


def test_run_on_an_empty_table(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registry():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert set(entry.oracle_sql()) <= set(entry.queries())

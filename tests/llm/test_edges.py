"""Every operator on nulls, empty and long texts, repeated rows and ids, extra
columns with clashing names, and on an empty table."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from aerolens.llm import (
    byte_bpe,
    decontaminate,
    language_id,
    license_scan,
    line_dedup,
    minhash_dedup,
    secret_scan,
    substring_rlz,
    suffix_dedup,
)
from llm_helpers import AWKWARD, LONG, awkward, expected_ids, ids, nothing

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def bench(spark):
    return spark.createDataFrame(
        [("b1", "quick brown fox jumps over the lazy dog near the river bank"), (None, "naïve façade"), ("b3", None),
         ("b4", ""), ("b5", "NULL byte")],
        "item_id string, text string",
    )


OPERATORS = {
    "minhash": lambda s, d: minhash_dedup.near_duplicates(d),
    "language": lambda s, d: language_id.predict(d, language_id.train(d)),
    "secrets": lambda s, d: secret_scan.secrets(d),
    "substring": lambda s, d: substring_rlz.substring_dedup(d),
    "suffix": lambda s, d: suffix_dedup.suffix_dedup(d),
    "bpe": lambda s, d: byte_bpe.byte_bpe(d, RANKS, public_tokenizers.PATTERN),
    "lines": lambda s, d: line_dedup.line_dedup(d),
    "licenses": lambda s, d: license_scan.licenses(d),
    "decontaminate": lambda s, d: decontaminate.contamination(d, bench(s)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_comes_back(spark, name):
    assert ids(OPERATORS[name](spark, awkward(spark))) == expected_ids()


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, nothing(spark)).collect() == []


def by_text(frame, docs):
    """Results beside the texts of rows with an unambiguous id."""
    return {r["doc_id"]: r for r in frame.collect()}


def test_minhash_results(spark):
    got = by_text(minhash_dedup.near_duplicates(awkward(spark)), awkward(spark))
    assert got[2]["n_shingles"] == 0 and got[2]["kept"] and got[2]["component_id"] == 2
    rows = minhash_dedup.near_duplicates(awkward(spark)).collect()
    assert [r["kept"] for r in rows if r["doc_id"] == 1] == [True, True]
    # The null id that repeats document 1 joins it; the one without text stays alone.
    assert sorted((r["component_id"] is None, r["kept"]) for r in rows if r["doc_id"] is None) == [(False, False), (True, True)]
    assert got[5]["kept"] and sorted(r["component_id"] for r in rows if r["doc_id"] == 6) == [5, 6]


def test_suffix_results(spark):
    rows = suffix_dedup.suffix_dedup(awkward(spark)).collect()
    # Equal ids aren't smaller than each other; document 6 holds document 5.
    assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] in (1, 5))
    six = max((r for r in rows if r["doc_id"] == 6), key=lambda r: r["n_bytes"])
    assert six["n_removed"] >= len(LONG) and bytes(six["kept"]).endswith(b"end")
    null = [r for r in rows if r["doc_id"] is None and r["n_bytes"]]
    assert null[0]["n_removed"] > 50


def test_substring_results(spark):
    rows = substring_rlz.substring_dedup(awkward(spark)).collect()
    five = next(r for r in rows if r["doc_id"] == 5)
    assert five["n_removed"] == five["n_words"] == 24_000
    assert all(r["n_words"] == 0 and r["kept"] == "" for r in rows if r["doc_id"] in (2, 3, 4))


def test_line_results(spark):
    rows = line_dedup.line_dedup(awkward(spark)).collect()
    assert all(r["removed"] == [] for r in rows if r["doc_id"] in (1, 2, 3, 4, 5, 7))
    two = next(r for r in rows if r["doc_id"] == 2)
    assert two["kept"] is None
    # One edit away from document 1; the null id comes last.
    assert [r["removed"] for r in rows if r["doc_id"] is None and r["text"]] == [[0]]


def test_language_results(spark):
    rows = language_id.predict(awkward(spark), language_id.train(awkward(spark))).collect()
    for r in rows:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (2, 3, 4, 7):
            assert (r["lang_pred"], r["rejected"]) == ("und", True)
    none = language_id.train(nothing(spark))
    assert {r["lang_pred"] for r in language_id.predict(awkward(spark), none).collect()} == {"und"}


def test_decontamination_results(spark):
    rows = {(r["doc_id"], r["n_words"]): r for r in decontaminate.contamination(awkward(spark), bench(spark)).collect()}
    assert rows[1, 14]["items"] == ["b1"] and rows[1, 14]["n_hit"] == 12
    assert [r["items"] for (i, _), r in rows.items() if i == 8] == [["b5"]]
    assert not any(r["contaminated"] for (i, _), r in rows.items() if i in (2, 3, 4, 5, 6, 7))


def test_bpe_and_secret_and_license_results(spark):
    texts = {t for _, t, *_ in AWKWARD if t is not None}
    rows = byte_bpe.byte_bpe(awkward(spark), RANKS, public_tokenizers.PATTERN).collect()
    assert {bytes(r["decoded"]).decode() for r in rows} == texts | {""}
    assert all(r["spans"] == [] for r in secret_scan.secrets(awkward(spark)).collect())
    assert all(r["findings"] == [] for r in license_scan.licenses(awkward(spark)).collect())


def test_missing_columns_fail_at_once(spark):
    with pytest.raises(Exception, match="absent"):
        secret_scan.secrets(awkward(spark), text_col="absent")


# ------------------------------------------------------------- stage forms

#: Names that stages use themselves or might, another case, a dot, a backtick.
CLASHING = ["_rid", "_rtext", "_lines", "_row", "own_rid", "OWN_RTEXT", "own_lines", "own_row", "least", "component", "a.b", "tick`s"]


def clashing(spark, frame):
    return frame.select("*", *(F.lit(f"kept {k}").alias(c) for k, c in enumerate(CLASHING)))


STAGES = {
    "accepted": lambda s, d: language_id.accepted(d, language_id.train(d)),
    "lines": lambda s, d: line_dedup.drop_repeated_lines(d),
    "one_of_each": lambda s, d: minhash_dedup.one_of_each(d),
    "uncontaminated": lambda s, d: decontaminate.uncontaminated(d, bench(s)),
    "tokenized": lambda s, d: byte_bpe.tokenized(d, RANKS, public_tokenizers.PATTERN),
}
#: By stage the ids of awkward rows that go, a null one as -1.
GONE = {
    "accepted": [2, 3, 4, 7, -1],
    "lines": [-1],
    "one_of_each": [1, -1, 6],
    "uncontaminated": [1, 1, -1, 8],
    "tokenized": [],
}


@pytest.mark.parametrize("name", STAGES)
def test_stage_forms_on_awkward_rows(spark, name):
    docs = clashing(spark, awkward(spark))
    got = STAGES[name](spark, docs)
    if name != "tokenized":
        assert got.columns == docs.columns and got.schema.simpleString() == docs.schema.simpleString()
    rows = got.collect()
    left = sorted([-1 if i is None else i for i, *_ in AWKWARD])
    for i in GONE[name]:
        left.remove(i)
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in rows) == left
    if name != "tokenized":
        assert all([r[c] for c in CLASHING] == [f"kept {k}" for k in range(len(CLASHING))] for r in rows)


@pytest.mark.parametrize("name", STAGES)
def test_stage_forms_on_an_empty_table(spark, name):
    assert STAGES[name](spark, clashing(spark, nothing(spark))).collect() == []

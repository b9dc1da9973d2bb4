"""Queries against their SQL, their columns, and the plans of those without Python."""

import pytest

import corpus_pipeline
from check import TYPES, bag, duck
from commerce_lens.llm.queries import ORACLE, QUERIES
from tests.conftest import SMALL, plan

COLUMNS = {
    "op1_bpe_tree": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op4_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op5_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op6_language_model": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op7_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op8_chat": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op9_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_filter_audit": {
        "part": "string", "filter_order": "string", "step": "int",
        **{c: "bigint" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")},
    },
    "op12_source_mix": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op13_hard_negatives": {
        "anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint",
    },
}


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe_tokens",
    ]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    cursor = duck(SMALL).execute(ORACLE[name])
    columns = {d[0]: str(d[1]) for d in cursor.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == columns
    assert bag(df.columns, map(tuple, df.collect())) == bag(list(columns), cursor.fetchall())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert dict(QUERIES[name](spark, SMALL).dtypes) == COLUMNS[name]


@pytest.mark.parametrize("name", ["op7_exact_dedup", "op8_chat", "op10_pseudonyms"])
def test_native_plans_hold_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))

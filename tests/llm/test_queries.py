"""The registered queries: the columns that their contracts name, whole tables, and SQL where there is some."""

import duckdb
import pytest

import __spark_entry__ as entry
from lakemart.llm import QUERIES, SQL
from tests.llm.helpers import SF

COLUMNS = {
    "op1_best_fit_packing": "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    "op2_simhash_near_dedup": "doc_id long, fingerprint string, component_id long",
    "op3_pii": "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    "op4_quality_votes": "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                         "base_failed boolean, kept boolean",
    "op5_flow_sharding": "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int",
    "op6_nn_descent_dedup": "vec_id long, n_links long, component_id long, kept boolean",
    "op7_paragraph_dedup": "doc_id long, kind string, start long, stop long, component_id long, removed boolean",
    "op8_chat_format": "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    "op9_hierarchical_mix": "doc_id long, domain string, lang string, source string, tokens long, epoch int",
    "op10_language_codes": "doc_id long, held_out boolean, lang_pred string, score double",
    "op11_license_scan": "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                         "labels string, score double",
    "op12_polar_whitening": "vec_id long, component int, n long, deviation long, whitened double, explained double, "
                            "identity_error double",
    "op13_merkle_descent": "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                           "verified boolean",
}
#: Queries with one row per row of their table.
WHOLE = {"op2_simhash_near_dedup": "documents", "op3_pii": "documents", "op4_quality_votes": "documents",
         "op5_flow_sharding": "documents", "op6_nn_descent_dedup": "embeddings", "op10_language_codes": "documents",
         "op11_license_scan": "documents", "op13_merkle_descent": "documents"}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and set(COLUMNS) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    types = {f.name: f.dataType.simpleString().replace("bigint", "long") for f in df.schema}
    assert dict(c.split() for c in COLUMNS[name].split(", ")).items() <= types.items()
    rows = df.collect()
    assert rows
    if name in WHOLE:
        assert len(rows) == spark.read.parquet(f"{SF}/{WHOLE[name]}.parquet").count()
    if name in SQL:
        con = duckdb.connect()
        for table in ("documents", "conversations"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
        result = con.execute(SQL[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == sorted(df.columns)
        expected = sorted(str([r[names.index(c)] for c in sorted(names)]) for r in result.fetchall())
        assert sorted(str([r[c] for c in sorted(names)]) for r in rows) == expected

"""The operators as named queries: each takes (spark, folder) and reads whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import (
    bit_slices,
    decontamination,
    language,
    line_chunks,
    mixing,
    outliers,
    piece_table,
    quality,
    resampling,
    simhash,
    sketch_windows,
    suffix_merge,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(build: Callable[..., DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


@_query("op1_template_decontamination")
def _op1(table) -> DataFrame:
    return decontamination.contamination(table("documents"), table("benchmark"))


@_query("op2_suffix_merge")
def _op2(table) -> DataFrame:
    return suffix_merge.dedup(table("documents"))


@_query("op3_simhash_covering")
def _op3(table) -> DataFrame:
    return simhash.near_duplicates(table("documents"))


@_query("op4_subword_quality")
def _op4(table) -> DataFrame:
    return quality.scored(table("documents"), table("labels"))


@_query("op5_ftrl_toxicity")
def _op5(table) -> DataFrame:
    return toxicity.scored(table("documents"), table("labels"))


@_query("op6_robust_outliers")
def _op6(table) -> DataFrame:
    return outliers.rules(table("documents"))


@_query("op7_line_chunks", line_chunks.LINES_SQL.format(docs="documents"))
def _op7(table) -> DataFrame:
    return line_chunks.dedup(table("documents"), detail=True)


@_query("op8_rank_order_language")
def _op8(table) -> DataFrame:
    return language.identified(table("documents"))


@_query("op9_count_min_windows")
def _op9(table) -> DataFrame:
    return sketch_windows.dedup(table("documents"))


@_query("op10_weighted_mixing", mixing.MIX_SQL.format(docs="documents"))
def _op10(table) -> DataFrame:
    return mixing.mix(table("documents"))


@_query("op11_piece_table")
def _op11(table) -> DataFrame:
    from public_tokenizers import path

    return piece_table.round_trip(table("documents"), piece_table.Vocabulary.load(path("piece_bpe_32k.model")))


@_query("op12_bit_sliced_search", bit_slices.SEARCH_SQL)
def _op12(table) -> DataFrame:
    return bit_slices.search(table("documents"), table("benchmark"))


@_query("op13_importance_resampling", resampling.RESAMPLE_SQL)
def _op13(table) -> DataFrame:
    return resampling.resample(table("documents"), table("benchmark"))

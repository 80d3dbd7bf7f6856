"""Registered queries of the training-data operators, over whole tables and whole texts."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import common, jaccard, licences, lines, merkle, mixing, packing, repeats, secrets, suffixes, toxicity, trie, variants, vectors


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(common.table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": _over("documents", mixing.digest),
    "op2_vectors": _over("embeddings", vectors.digest),
    "op3_secrets": _over("documents", secrets.digest),
    "op4_packing": _over("documents", packing.digest),
    "op5_jaccard": _over("documents", jaccard.digest),
    "op6_repeats": _over("documents", repeats.digest),
    "op7_suffixes": _over("documents", suffixes.digest),
    "op8_licences": _over("documents", licences.digest),
    "op9_toxicity": lambda spark, sf_dir: toxicity.digest(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")),
    "op10_merkle": _over("documents", merkle.digest),
    "op11_trie": _over("conversations", trie.digest),
    "op12_lines": _over("documents", lines.digest),
    "op13_variants": _over("documents", variants.digest),
}
SQL: dict[str, str] = {"op1_mixing": mixing.SQL, "op6_repeats": repeats.SQL, "op10_merkle": merkle.SQL, "op11_trie": trie.SQL, "op12_lines": lines.SQL, "op13_variants": variants.SQL}

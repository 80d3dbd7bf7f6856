"""The corpus pipeline, stage by stage, against plain versions; and the guard of the entry module."""

import os
import subprocess
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare, database
from hearthgrid.llm import mixing, toxicity

from .conftest import SF
from .test_jaccard import plain
from .test_models import check_packing
from .test_native import plain_base


def test_stages(spark, corpus, tmp_path):
    docs, seen = corpus, []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{number}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{number}")
        seen.append(name)
        if name != "packing":
            assert docs.columns == corpus.columns
            old, new = ([(r["doc_id"], r["text"], r["source"]) for r in df.collect()] for df in (before, docs))
        if name == "toxicity":
            scores = toxicity.digest(before, spark.read.parquet(f"{SF}/labels.parquet")).collect()
            assert Counter(r[0] for r in new) == Counter(r["doc_id"] for r in scores if not r["predicted"])
        elif name == "near-copies":
            groups = plain([r[:2] for r in old])
            assert sorted(str(r[0]) for r in new) == sorted(i for i, _, root in groups if i == root)
        elif name == "secrets":
            assert sorted(r[0] for r in new) == sorted(r[0] for r in old)
            clean = {r[0]: r[1] for r in old if not plain_base(r[1])}
            assert clean and all(r[1] == clean[r[0]] for r in new if r[0] in clean)
            assert not any(plain_base(r[1]) for r in new)
        elif name == "mixing":
            want = {r["doc_id"]: r["taken"] for r in mixing.digest(before).collect()}
            got = Counter()
            for doc_id, text, _ in new:
                got[doc_id] += len(text.encode().split())
            assert got == Counter({k: v for k, v in want.items() if v})
        else:
            texts = [(r["doc_id"], r["text"]) for r in before.collect()]
            used, least = check_packing(docs.collect(), texts)
            assert used <= least * 1.03 + 2
    assert seen == ["toxicity", "near-copies", "secrets", "mixing", "packing"]


def test_run(spark):
    out = entry.queries()["pipeline"](spark, SF)
    assert out.count() > 0 and "sequence_id" in out.columns


ODD = [(1, None, None), (2, "", "own"), (3, "one two three password=hunter22", "a"), (3, "one two three password=hunter22", "a"), (None, "four five six", "a"), (5, "x" * 20_000, None)]
CLASHING = ("score", "size", "target", "takes", "position", "_id", "_k1", "_key", "_spans", "k1", "found", "row")


@pytest.mark.parametrize("rows", [ODD, ODD[:2], []])
def test_odd_documents_and_clashing_columns(spark, tmp_path, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    full = [(i, t, "en", s, len(t) if t is not None else None, *(f"{c} of {i}" for c in CLASHING)) for i, t, s in rows]
    docs = spark.createDataFrame(full, schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        assert docs.columns == [f.split()[0] for f in schema.split(", ")]
        assert all(r[c] == f"{c} of {r['doc_id']}" for r in docs.collect() for c in CLASHING), name
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == {r["doc_id"] for r in docs.collect()} and (bool(out) or not any((t or "").split() for _, t, _ in rows))


def test_library_without_this_part():
    """Nothing outside needs it: the entry module loads with the subpackage out of reach."""
    code = (
        "import sys\n"
        "class Away:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('corpus_pipeline', 'hearthgrid.llm')):\n"
        "            raise ModuleNotFoundError('away', name=name)\n"
        "sys.meta_path.insert(0, Away())\n"
        "import __spark_entry__ as e\n"
        "assert not e.LLM_QUERIES and e.queries() and set(e.queries()) == set(e.oracle_sql())\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry.__file__.rsplit("/", 1)[0])


@pytest.mark.parametrize("key", sorted(entry.LLM_SQL))
def test_sql(spark, key):
    _, result = compare(spark, database(SF), key, SF)
    assert result.startswith("ok"), result

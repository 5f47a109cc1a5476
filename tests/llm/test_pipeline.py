"""The pipeline's stages on their own inputs, the registered queries, and the guard around the folder."""

import importlib
import re
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_lines_and_pages import brute_force as without_repeats
from tests.llm.test_near_duplicates import brute_force as groups
from wardlight.llm import quality, queries, toxicity

FOLDER = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [sum(bool(re.match(rf"op{n}_", x)) for x in names) for n in range(1, 14)] == [1] * 13
    assert names["pipeline"] is corpus_pipeline.run and set(queries.ORACLE) <= set(queries.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "line_dedup", "minhash_near_dedup", "best_fit_packing"]


def test_the_rest_works_without_the_folder():
    code = (
        "import sys; sys.modules['wardlight.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; names = e.queries(); print(len(names), 'pipeline' in names, any(n.startswith('op') and n[2].isdigit() for n in names), len(e.oracle_sql()))"
    )
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(said[0]) > 80 and said[1:3] == ["False", "False"] and int(said[3]) > 70


def test_nothing_else_imports_the_folder():
    for file in [*ROOT.glob("wardlight/**/*.py"), *ROOT.glob("tools/*.py"), ROOT / "bench.py"]:
        if "llm" not in file.relative_to(ROOT).parts:
            assert not re.search(r"import.*\bllm\b|from.*\bllm\b", file.read_text(encoding="utf-8")), file
    importlib.import_module("wardlight.llm")


def test_stages(spark, tmp_path):
    extra = [
        (100_000, None, "en", "src0", None),
        (100_001, "", "en", None, 0),
        (None, "A document without an id that still has enough different words to be kept by every one of the rules we have here.", None, "src1", 5),
    ]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = docs.unionAll(spark.createDataFrame(extra, docs.schema))
    columns, inputs = docs.columns, docs
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, inputs, FOLDER)
        out.write.parquet(f"{tmp_path}/{name}")
        inputs = spark.read.parquet(f"{tmp_path}/{name}")
        outputs.append(inputs)
        if name != "best_fit_packing":
            assert inputs.columns == columns

    rows = [[(r["doc_id"], r["text"], r["n_chars"]) for r in df.collect()] for df in (docs, *outputs[:4])]
    number = lambda i: -1 if i is None else i
    net = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = toxicity.score_documents(docs, net).collect()
    assert sorted(number(r["doc_id"]) for r in scores if r["score"] < 0.5) == sorted(number(i) for i, *_ in rows[1])
    kept = [number(r["row"]["doc_id"]) for r in quality.judge(outputs[0]).collect() if r["kept"]]
    assert sorted(kept) == sorted(number(i) for i, *_ in rows[2]) and -1 in kept
    expected = without_repeats([r[:2] for r in rows[2]], 50)
    assert {i: t for i, t, _ in rows[3]} == {i: t for i, (t, *_) in expected.items()}
    assert all(n == len(t) for _, t, n in rows[3])
    roots = groups([r[:2] for r in rows[3] if r[0] is not None], corpus_pipeline.SIMILAR)
    assert sorted(number(i) for i, *_ in rows[4]) == sorted([i for i, r in roots.items() if i == r] + [-1])
    pieces = outputs[4].collect()
    assert {r["doc_id"] for r in pieces} == {i for i, *_ in rows[4]} and max(r["offset"] + r["length"] for r in pieces) <= 4096

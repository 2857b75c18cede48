"""The pipeline end to end against brute force, and static guards."""

import ast
import pathlib

import corpus_pipeline
from tests_llm_helpers import brute_pipeline

ROOT = pathlib.Path(__file__).resolve().parents[2]
PACKAGE = ROOT / "wavecohort" / "llm"

# (module, function) that bring rows to the driver -> what bounds them
REVIEWED_PULLS = {
    ("attention_lm.py", "word_counts"): "one row",
    ("attention_lm.py", "forward"): "none: take of numpy",
    ("attention_lm.py", "log_odds"): "none: take of numpy",
    ("attention_lm.py", "gradients"): "none: take of numpy",
    ("attention_lm.py", "gather"): "none: take of numpy",
    ("attention_lm.py", "id_counts"): "one row per id of the vocabulary",
    ("attention_lm.py", "train_round"): "one row per model parameter",
    ("centroids.py", "first_centroids"): "one row per centroid",
    ("centroids.py", "cluster_sums"): "one row per centroid and dimension",
    ("centroids.py", "cluster"): "one row per centroid",
    ("components.py", "_state"): "one row: count and checksum",
    ("html_text.py", None): "none",
    ("importance.py", "log_ratios"): "one row per n-gram bucket",
    ("importance.py", "kth_largest"): "at most 65,536 digit counts",
    ("importance.py", "quantile_level"): "held_out_labels rows",
    ("licenses.py", "load_templates"): "one row per template or chunk",
    ("packing.py", "settle"): "one row",
    ("quality_rules.py", "prior"): "one row",
    ("target_resampling.py", "gains"): "one row per bucket",
    ("target_resampling.py", "kth_smallest"): "at most ``pivots`` keys, 2 * ``pivots`` + 1 counts",
    ("token_store.py", "train_dictionary"): "one row",
    ("token_store.py", "read_store"): "one row",
    ("topk.py", "top_k"): "one row",
}


def calls(path):
    out = []

    def visit(node, fn):
        if isinstance(node, ast.FunctionDef):
            fn = fn or node.name
        if isinstance(node, ast.Attribute):
            out.append((fn, node.attr))
        for child in ast.iter_child_nodes(node):
            visit(child, fn)

    visit(ast.parse(path.read_text()), None)
    return out


def test_driver_pulls_are_reviewed():
    for path in PACKAGE.glob("*.py"):
        for fn, name in calls(path):
            if name in {"collect", "toPandas", "first", "take", "head", "tail", "toLocalIterator"}:
                assert (path.name, fn) in REVIEWED_PULLS, (path.name, fn, name)


def test_no_cross_join_local_checkpoint_or_rdd():
    for path in [*PACKAGE.glob("*.py"), ROOT / "corpus_pipeline.py"]:
        used = {name for _, name in calls(path)}
        assert not used & {"crossJoin", "localCheckpoint", "rdd", "mapPartitions", "cartesian", "sample"}, path.name


def test_nothing_else_imports_the_subpackage():
    for path in ROOT.rglob("*.py"):
        if "llm" in path.parts or path.name in ("corpus_pipeline.py", "__spark_entry__.py"):
            continue
        assert "wavecohort.llm" not in path.read_text() and ".llm" not in path.read_text(), path


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, sf)
        assert after.columns == docs.columns
        kept = spark.createDataFrame(after.collect(), docs.schema)
    want = brute_pipeline(docs, labels)
    assert sorted(r.doc_id for r in kept.collect()) == want
    packed = corpus_pipeline.run(spark, sf).collect()
    assert sorted({r.doc_id for r in packed}) == want


def test_pipeline_of_empty_and_null_tables(spark, sf, tmp_path):
    """An empty table gives no rows; documents without text or id fail the
    quality rules; all stages keep the columns of documents."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    good = " ".join(f"word{i}" for i in range(50))
    tables = {"empty": [], "null": [(None, None, None, None, None)] * 3, "mixed": [(None, good, "en", None, 1), (4, None, "en", "s", 0)]}
    for name, rows in tables.items():
        folder = tmp_path / name
        spark.createDataFrame(rows, schema).write.parquet(str(folder / "documents.parquet"))
        labels.write.parquet(str(folder / "labels.parquet"))
        packed = corpus_pipeline.run(spark, str(folder)).collect()
        assert [r.doc_id for r in packed] == ([None] if name == "mixed" else [])

"""Static guards for the execution design.

Every call that brings rows to the driver must be one of the reviewed,
bounded pulls listed here with its bound; a new one fails until it is
reviewed and listed. Python runs only in the mixed-model passes (M2) and
the p-value helpers on coefficient-sized frames; no row-at-a-time UDF, no
RDD, no localCheckpoint anywhere in the library.
"""

import ast
import pathlib

ROOT = pathlib.Path(__file__).resolve().parent.parent / "wavecohort"

DRIVER_PULLS = {"collect", "toPandas", "first", "take", "head", "tail", "toLocalIterator"}

# (module, enclosing function, method) -> what bounds the rows pulled
REVIEWED_PULLS = {
    ("functions/quantile.py", "order_statistics", "collect"): "one row per partition; two values per probability",
    ("functions/quantile.py", "least_radius", "collect"): "one row per key, then one per key and slice",
    ("operators/describe.py", "cell_borders", "collect"): "one row per group, two per cell",
    ("operators/describe.py", "loess_curve", "collect"): "one row per group",
    ("operators/design.py", "used_levels", "first"): "one row of one flag per declared level",
    ("operators/lmm.py", "_evaluate", "collect"): "one vector of p^2 + p + 4 doubles per candidate parameter",
    ("operators/logit.py", "evaluate", "first"): "one row of sums per pass",
    ("operators/logit.py", "separating", "first"): "one row of two extremes",
    ("operators/ipcw.py", "load_logit", "collect"): "a saved model: one row per coefficient",
    ("operators/lmm.py", "at_theta", "first"): "one-row person count",
    ("operators/lmm.py", "fit_lmm", "first"): "one-row person count and constancy check",
    ("operators/lmm.py", "load_model", "collect"): "a saved model: p x p covariance entries",
    ("operators/predict.py", "covariate_means", "first"): "one row of covariate means",
    ("sources/csv_records.py", "__init__", "collect"): "one header",
    ("sources/column_types.py", "with_types", "collect"): "one row per column",
    ("sources/panel.py", "load_stage", "first"): "the newest manifest row; one row of count and checksum",
    ("sources/panel.py", "assert_keys", "first"): "one-row key check",
}

PYTHON_EXECUTION = {"mapInPandas", "applyInPandas", "mapInArrow", "applyInArrow", "pandas_udf", "udf",
                    "applyInPandasWithState", "foreach", "foreachPartition", "mapPartitions"}

# (module, enclosing function or decorated function, name)
REVIEWED_PYTHON = {
    ("operators/lmm.py", "_evaluate", "mapInPandas"),
    ("operators/lmm.py", "_evaluate", "applyInPandas"),
    ("functions/dist.py", "f_pvalue", "pandas_udf"),
    ("functions/dist.py", "chisq_pvalue", "pandas_udf"),
    ("functions/dist.py", "t975", "pandas_udf"),
}


def _calls():
    """(module, enclosing function, attribute name, receiver is the functions module)."""
    out = []
    for path in sorted(ROOT.rglob("*.py")):
        module = path.relative_to(ROOT).as_posix()
        if module.startswith("llm/"):  # reviewed by the tests of that subpackage
            continue
        tree = ast.parse(path.read_text(), filename=str(path))

        def visit(node, fn):
            if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
                fn = node.name if fn is None else f"{fn}.{node.name}"
                for dec in node.decorator_list:
                    target = dec.func if isinstance(dec, ast.Call) else dec
                    name = target.attr if isinstance(target, ast.Attribute) else getattr(target, "id", None)
                    if name in PYTHON_EXECUTION:
                        out.append((module, node.name, name, True))
            if isinstance(node, ast.Attribute):
                on_functions = isinstance(node.value, ast.Name) and node.value.id in {"F", "functions"}
                out.append((module, fn, node.attr, on_functions))
            for child in ast.iter_child_nodes(node):
                visit(child, fn)

        visit(tree, None)
    return out


def test_driver_pulls_are_reviewed_and_bounded():
    # F.first / F.head are column functions, not driver pulls
    found = {(m, fn, a) for m, fn, a, on_f in _calls() if a in DRIVER_PULLS and not on_f}
    assert found == set(REVIEWED_PULLS), sorted(found ^ set(REVIEWED_PULLS))


def test_python_runs_only_in_reviewed_places():
    found = {(m, fn, a) for m, fn, a, _ in _calls() if a in PYTHON_EXECUTION}
    assert found == REVIEWED_PYTHON, sorted(found ^ REVIEWED_PYTHON)


def test_no_rdd_or_local_checkpoint():
    bad = [(m, fn, a) for m, fn, a, _ in _calls() if a in {"rdd", "localCheckpoint", "parallelize"}]
    assert not bad, bad

import pytest

from barlake.llm import queries

NATIVE = ("op2_mixing", "op9_secrets")


@pytest.mark.parametrize("key", NATIVE)
def test_native_operators_run_no_python(spark, key):
    plan = queries.QUERIES[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_nothing_else_imports_this_package():
    import pathlib
    root = pathlib.Path(queries.__file__).parents[1]
    for f in root.rglob("*.py"):
        if f.parent.name != "llm":
            assert "llm" not in f.read_text(), f

from datetime import datetime

from strata.operators.cleanse import add_derived, cleanse, clean_columns, drop_missing_required
from strata.rules import CUSTOMER_RULES, CleanseRules

def test_strings_are_trimmed_and_some_lowered(spark):
    rows = [(1, " Mixed.Case@Host.Org", "On Hold ", "  Rue X  "), (2, None, "", "Y")]
    df = spark.createDataFrame(rows, "id int, email string, status string, street string")
    out = {r.id: tuple(r)[1:] for r in clean_columns(df, CleanseRules(string_cols=("email", "status", "street"))).collect()}
    assert out == {1: ("mixed.case@host.org", "on hold", "Rue X"), 2: (None, "", "Y")}


def test_each_required_column_must_be_there(spark):
    df = spark.createDataFrame([(1, "p", 5), (2, None, 5), (3, "q", None), (None, None, None)], "id int, a string, b int")
    rules = CleanseRules(required=("a", "b"))
    assert [r.id for r in cleanse(df, rules).collect()] == [1]
    assert sorted(r.id for r in cleanse(df, CleanseRules(required=("a",))).collect()) == [1, 3]


def test_derived_column_skipped_without_inputs(spark):
    df = spark.createDataFrame([(7, "q@r.st")], "customer_id int, email string")
    out = cleanse(df, CUSTOMER_RULES, "customer_id")
    assert "full_name" not in out.columns


def test_derived_full_name_uses_trimmed_parts(spark):
    df = spark.createDataFrame([(" Ann ", None)], "first_name string, last_name string")
    rules = CleanseRules(string_cols=("first_name", "last_name"), derived=CUSTOMER_RULES.derived)
    out = add_derived(clean_columns(df, rules), rules).collect()[0]
    assert out.full_name == "Ann "


def test_blank_passes_required_by_default_and_not_with_option(spark):
    df = spark.createDataFrame([("C1", "   "), ("C2", "b@c.d")], "customer_id string, email string")
    rules = CleanseRules(required=("email",), string_cols=("email",))
    assert cleanse(df, rules).count() == 2
    strict = CleanseRules(required=("email",), string_cols=("email",), blank_as_null=True)
    assert [r.customer_id for r in cleanse(df, strict).collect()] == ["C2"]


def test_tabs_survive_trim(spark):
    df = spark.createDataFrame([("\tx\t",)], "name string")
    out = clean_columns(df, CleanseRules(string_cols=("name",))).collect()[0]
    assert out.name == "\tx\t"


def test_malformed_values_become_null(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-01 10:00:00", "12.5"), ("2", "not a time", "n/a")], "id string, created_at string, amount string"
    )
    rules = CleanseRules(ts_cols=("created_at",), numeric_cols=("amount",))
    rows = sorted(clean_columns(df, rules).collect())
    assert rows[0].created_at == datetime(2024, 1, 1, 10, 0) and rows[0].amount == 12.5
    assert rows[1].created_at is None and rows[1].amount is None


def test_primary_key_always_required(spark):
    df = spark.createDataFrame([(None, "a@b.c"), ("K", "d@e.f")], "k string, email string")
    assert cleanse(df, CleanseRules(), primary_key="k").count() == 1


def test_bronze_columns_dropped(spark):
    df = spark.createDataFrame([("1", "{}", "orders")], "id string, raw_document string, source_collection string")
    assert cleanse(df, CleanseRules()).columns == ["id"]


def test_drop_missing_required_ignores_absent_columns(spark):
    df = spark.createDataFrame([("1",)], "id string")
    assert drop_missing_required(df, ["email"]).count() == 1


def test_single_projection_plan(spark):
    df = spark.createDataFrame([(" a ", "B")], "email string, status string")
    plan = cleanse(df, CleanseRules(string_cols=("email", "status")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1

import pytest

from tarnwork import fixed_values as fv
from tarnwork.operators import govern

STAFF = [
    (1, "anna.k@example.com", 75000.0, "APAC"),
    (2, "ben@example.com", 68000.0, "EMEA"),
    (3, "no address", 1.0, None),
    (4, "c@example.com", None, "APAC"),
]


@pytest.fixture
def staff(spark):
    df = spark.createDataFrame(STAFF, "id int, email string, salary double, region string")
    tags = {"email": "pii_email", "salary": "salary", "region": "region_apac"}
    return govern.tag_columns(df, {c: {fv.TAG_KEY: t} for c, t in tags.items()})


def test_tags(staff):
    more = govern.tag_columns(staff, {"email": {"owner": "hr"}})
    assert govern.column_tags(more)["email"] == {fv.TAG_KEY: "pii_email", "owner": "hr"}
    assert "id" not in govern.column_tags(more)
    assert govern.column_tags(more.where("id > 1").select("email"))["email"]["owner"] == "hr"


def test_masks_and_filter(staff, rows):
    seen = govern.apply_policies(staff, govern.EMPLOYEE_POLICIES)
    assert rows(seen) == [(1, "a****k@example.com", -99.99, "APAC"), (4, "cc@example.com", -99.99, "APAC")]
    assert govern.column_tags(seen) == govern.column_tags(staff)


def test_filter_tests_the_true_value(staff, rows):
    policies = [
        govern.Policy("mask", (fv.TAG_KEY, "region_apac"), lambda c: fv_masked(c)),
        *govern.EMPLOYEE_POLICIES,
    ]
    assert [r[0] for r in rows(govern.apply_policies(staff, policies))] == [1, 4]


def fv_masked(_):
    from pyspark.sql import functions as F

    return F.lit("hidden")


def test_exempt_readers(staff, rows):
    policies = [govern.Policy(p.kind, p.tag, p.function, frozenset({"hr"})) for p in govern.EMPLOYEE_POLICIES]
    assert rows(govern.apply_policies(staff, policies, ["hr", "it"])) == sorted(STAFF)
    assert len(rows(govern.apply_policies(staff, policies, ["it"]))) == 2


def test_sql_functions(spark):
    govern.register_functions(spark)
    row = spark.sql(
        "SELECT mask_email('anna@x'), mask_email('a@b@c'), mask_email('none'), mask_email('@x'), mask_salary(5.0), "
        "is_apac_region('APAC'), is_apac_region(NULL)"
    ).first()
    assert tuple(row) == ("a**a@x", "aa@b@c", None, None, -99.99, True, False)


def test_kind():
    with pytest.raises(ValueError):
        govern.Policy("hide", ("a", "b"), lambda c: c)

"""The structs of an endpoint are found once, however many rules it has."""

from codefacts.operators import schemas as S


def tables(spark):
    rules = spark.createDataFrame([("R1", 1, "E1"), ("R2", 2, "E1"), ("R3", 3, "none"), ("R4", 4, "E2"), ("R5", 5, None), ("R6", 6, "E3")],
                                  "rule_id string, ord int, entrypoint_id string")
    eps = spark.createDataFrame([("E1", 1, "POST", "old"), ("E1", 2, "GET", "getA"), ("E2", 3, "PUT", ""), ("E3", 4, "GET", "getB"), ("E4", 5, "GET", None)],
                                "ep_id string, ord int, method string, handler_symbol string")
    reg = spark.createDataFrame([("GetAParam",), ("getAResp",), ("getBParam",), ("Param",)], "name string")
    return rules, eps, reg, spark.createDataFrame([("getB", "Gone"), ("", "Param")], "handler string, struct string")


def test_flags_and_structs(spark):
    got = {r.rule_id: tuple(r)[2:] for r in S.rule_schemas(spark, *tables(spark)).collect()}
    e1 = ("E1", True, "getA", "GET", "GetAParam", True, "getAResp", True, False)
    assert got == {"R1": e1, "R2": e1, "R3": ("none", False, None, None, None, False, None, False, False),
                   "R4": ("E2", False, "", "PUT", None, False, None, False, True),
                   "R5": (None, False, None, None, None, False, None, False, False),
                   "R6": ("E3", True, "getB", "GET", "Gone", False, None, False, True)}


def test_rules_are_joined_once(spark):
    plan = S.rule_schemas(spark, *tables(spark))._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert "entrypoint_id" in joins[0]

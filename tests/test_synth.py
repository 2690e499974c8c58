import re

from pyspark.sql import functions as F

from claimwise.functions.text import squeeze
from claimwise.operators import synth

ROWS = [(1, " Saab ", "A  3", "2004", "Total Loss", "Rear Collision", None), (2, None, None, None, None, None, None),
        (3, "VW\u00a0", "\tGolf\n\nII ", "", "Minor Damage", "?", " Parked Car "), (None, "x", "y", "1", "z", "", "Vehicle Theft")]
COLUMNS = "id long, auto_make string, auto_model string, auto_year string, incident_severity string, collision_type string, incident_type string"


def test_squeeze_equals_one_pattern(spark):
    texts = ["", " ", "a b", " a  b ", "a\tb", "a \t b", "\u00a0a\u2003\u2003b\u3000", "a\r\n\n", "\x1c\x1fa \x85 b", "a\u200bb", None, "ä   ö\u2028\u2029ü"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(squeeze(F.col("t")).alias("t")).collect()
    assert [r["t"] for r in found] == [t if t is None else re.sub(r"\s{2,}|[^\S ]", " ", t).strip(" ") for t in texts]


def test_clauses_stand_once_in_the_plan(spark):
    made = synth.generate_reports(spark.createDataFrame(ROWS, COLUMNS), "id", seed=7)
    texts = [r["generated_description"] for r in made.collect()]
    assert len(texts) == 4 and all(t and t == " ".join(t.split()) for t in texts)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    # a branch a plan repeats every clause; the compiler gives up on such code
    assert "WHEN (_plan" not in plan

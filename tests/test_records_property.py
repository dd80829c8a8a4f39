"""Property: assembling a description file returns every record's text exactly.

Texts may hold digits, '|' and newlines; the one thing excluded is a line that
starts with '<digits>|' inside a record, which no rule can tell from a record start.
"""
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fundscope.operators import records

LINE_START_MARKER = re.compile(r"(^|\n)[0-9]+\|")
texts = st.text(alphabet="ab |\n0123456789", max_size=30).filter(
    lambda t: not LINE_START_MARKER.search("x" + t))


@settings(max_examples=25, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lo=st.integers(0, 120), body=st.lists(texts, min_size=1, max_size=12))
def test_round_trip(spark, lo, body):
    hi = lo + len(body)
    value = "\n".join(f"{lo + i}|{t}" for i, t in enumerate(body))
    files = spark.createDataFrame([(f"project_description_{lo}_{hi}.txt", value)],
                                  "file_name string, value string")
    got = {r.idx: r.text for r in records.assemble_records(files).collect()}
    assert got == {lo + i: t for i, t in enumerate(body)}
    assert records.missing_records(files).count() == 0

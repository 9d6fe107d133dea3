"""The registered queries against their SQL, and the registration itself."""

import pytest

from marquee.llm.oracle import ORACLE
from marquee.llm.queries import QUERIES
from tests.check_oracle import compare, duck

from .helpers import SF


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(SF), name, QUERIES[name], ORACLE[name], SF)


def test_all_operators_are_registered():
    import __spark_entry__ as E
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())


def test_native_operators_run_no_python(spark):
    import io
    from contextlib import redirect_stdout
    for name in ("op1_url_filter", "op8_histogram_sort"):
        with redirect_stdout(io.StringIO()) as out:
            QUERIES[name](spark, SF).explain("formatted")
        assert not any(x in out.getvalue() for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))

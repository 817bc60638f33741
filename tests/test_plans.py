"""Plans that must not get worse: generated code the JIT compiles, columns read, joins and shuffles."""

import contextlib
import io
import re

import pytest

from shiftlens import fixtures
from shiftlens.plans import kpi, silver
from shiftlens.workload import Layers

SF_DIR = "/root/testdata/sf0.001"


def explained(df, mode):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("layer", ["employee", "timesheet"])
def test_generated_code_of_cleaning_is_compiled(spark, tmp_path, layer):
    raw = getattr(fixtures, f"raw_{layer}")(spark, SF_DIR)
    raw.write.parquet(str(tmp_path / layer))
    cleaned = getattr(silver, f"clean_{layer}")(spark.read.schema(raw.schema).parquet(str(tmp_path / layer)))
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", explained(cleaned, "codegen"))]
    assert sizes and max(sizes) < 7000  # the JIT takes methods of up to 8000 bytecodes; joins and writes add to it


@pytest.fixture(scope="module")
def stored_fact(spark, tmp_path_factory):
    """The fact as KPIs find it in a warehouse."""
    rows, path = Layers(spark, SF_DIR).fact, str(tmp_path_factory.mktemp("star") / "fact")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def test_kpis_read_only_their_columns_and_combine_before_the_join(spark, stored_fact):
    x = Layers(spark, SF_DIR)
    plan = explained(kpi.avg_hours(stored_fact, x.dim_employee), "formatted")
    assert "ReadSchema: struct<employee_key:bigint,hours_worked:double>" in plan
    tree = plan[: plan.index("(1) Scan")]
    assert tree.index("Join") < tree.index("HashAggregate", tree.index("Join"))  # an aggregate below the join
    late = explained(kpi.late_arrivals(stored_fact, x.dim_employee), "formatted")
    assert "ReadSchema: struct<employee_key:bigint,punch_in:timestamp_ntz,scheduled_start:string>" in late


def test_headcount_has_no_nested_loop(spark):
    x = Layers(spark, SF_DIR)
    plan = explained(kpi.active_headcount(x.dim_employee, x.dim_date), "formatted")
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rolling_mean_shuffles_the_fact_once(spark, stored_fact):
    x = Layers(spark, SF_DIR)
    plan = explained(kpi.rolling_avg_hours(stored_fact, x.dim_employee), "formatted")
    tree = plan[: plan.index("(1) Scan")]
    assert len(re.findall(r"\bExchange \(", tree)) == 1

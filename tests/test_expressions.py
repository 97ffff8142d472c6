"""Column expressions against small brute-force models."""

from datetime import datetime, timedelta
from decimal import Decimal
from fractions import Fraction
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from tideline.functions import quotas as q
from tideline.functions.arrays import append_when, no_strings, symmetric_difference
from tideline.functions.keys import join_prefix, landing_key, path_parts, strip_slashes
from tideline.functions.names import BLOCKED_PATTERNS, in_tenant, matches_any
from tideline.functions.texts import cut, hex_order, json_payload, last_line
from tideline.plans.quota import quota_figures, quota_message, quota_report
from tideline.plans.reports import SEPARATOR, failure_report, notices, run_state
from validation.check import plan_of


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(frame, expression):
    return [r[0] for r in frame.select("i", expression.alias("o")).orderBy("i").select("o").collect()]


def test_path_parts_are_stems_of_the_parents(spark):
    keys = ["a/pc_x/s1/20240101/f.snappy.parquet", "pc.x.y/.s1/2024.1/f", "b/t./..s/.t.u/f", "one/two/f", "f"]
    rows = column(spark, keys).select("i", *[e.alias(n) for n, e in path_parts(F.col("v")).items()]).orderBy("i").collect()
    for key, row in zip(keys, rows):
        folders = key.split("/")[:-1]
        wanted = [PurePosixPath(folders[-k]).stem if len(folders) >= k else None for k in (3, 2, 1)]
        assert [row["table_name"], row["cda_schema_id"], row["cda_timestamp"]] == wanted


def test_landing_key_strips_the_prefix_once_and_keeps_one_slash(spark):
    keys = column(spark, ["cda/pc/t/cda/pc/f", "t/f", "/t/f", "cda/pcx/f"])
    assert apply(keys, landing_key(F.col("v"), "cda/pc/"))[0] == "__copy_into__/t/cda/pc/f"
    assert apply(keys, landing_key(F.col("v"), "cda/pc"))[3] == "__copy_into__/cda/pcx/f"
    assert apply(keys, landing_key(F.col("v"), ""))[1:3] == ["__copy_into__/t/f", "__copy_into__/t/f"]


def test_prefixes(spark):
    values = column(spark, ["a/b//", "NOT AVAILABLE", "", "a"])
    assert apply(values, strip_slashes(F.col("v"))) == ["a/b", "", "", "a"]
    assert apply(values, join_prefix(strip_slashes(F.col("v")), F.lit("t"))) == ["a/b/t", "t", "t", "a/t"]


@pytest.mark.parametrize(
    ("name", "blocked"),
    [
        ("pct_a", True), ("pctax", False), ("PCT_A", True), ("pcstx", True), ("pcst", False), ("bcstx", False),
        ("bcst_x", True), ("xx_any", True), ("xxany", False), ("pc_myworkitem", True), ("pc_WorkItemSet", False),
        ("bcxtmp", True), ("cc_tmp1", True), ("ab_policy", False), ("bc_workitem", False), (None, None),
    ],
)
def test_block_patterns(spark, name, blocked):
    assert apply(column(spark, [name]), matches_any(F.col("v"))) == [blocked]


def test_unknown_tenant_is_an_error(spark):
    names = column(spark, ["pc_a"])
    assert apply(names, in_tenant(F.lit("MRG_PC"), F.col("v"))) == [True]
    with pytest.raises(Exception, match="no table pattern"):
        apply(names, in_tenant(F.lit("OTHER"), F.col("v")))


def test_arrays(spark):
    frame = spark.createDataFrame([(0, None, ["A", "B"]), (1, ["A", "C"], ["A", "B"])], "i int, a array<string>, b array<string>")
    assert apply(frame, append_when(F.col("a"), F.lit(True), "X")) == [["X"], ["A", "C", "X"]]
    assert apply(frame, append_when(F.col("a"), F.lit(None).cast("boolean"), "X")) == [[], ["A", "C"]]
    assert apply(frame, symmetric_difference(F.col("a"), F.col("b"))) == [None, ["C", "B"]]
    assert apply(frame, no_strings()) == [[], []]


def test_last_line_and_cut(spark):
    texts = ["a\nb", "a\nb\n", "a\r\nb\r\n", "one", "a\n\n", "a\rb"]
    assert apply(column(spark, texts), last_line(F.col("v"))) == [t.splitlines()[-1] for t in texts]
    assert apply(column(spark, ["abc", "a"]), cut(F.col("v"), 2)) == ["ab", "a"]
    assert apply(column(spark, ["abc", "a"]), cut(F.col("v"), None)) == ["abc", "a"]


def test_json_keeps_nulls(spark):
    frame = spark.createDataFrame([(0, "x", None, 1)], "i int, a string, b string, c int")
    assert apply(frame, json_payload(["a", "b", "c"])) == ['{"a":"x","b":null,"c":1}']


def test_hex_order_is_that_of_the_numbers(spark):
    values = [0, 9, 10, 255, 256, 2**40, 2**131, 2**131 + 1]
    shown = [form.format(v) for v, form in zip(values, ["{:x}", "0x{:02x}", "{:X}", "0XFF", "{:x}", "000{:x}", "{:x}", "0x{:X}"])]
    found = apply(column(spark, shown), hex_order(F.col("v")))
    assert found == sorted(found) and len(set(found)) == len(found)
    assert len(set(apply(column(spark, ["0xff", "FF", "00Ff"]), hex_order(F.col("v"))))) == 1


def test_percent_text(spark):
    values = ["90%", " 12.5% ", "", None, "100", "\t7%\n"]
    found = apply(column(spark, values), q.percent_ratio(F.col("v")))
    assert found == [Decimal("0.9"), Decimal("0.125"), None, None, Decimal(1), Decimal("0.07")]
    for bad in ("abc", "5%x", "   "):
        with pytest.raises(Exception, match="not a percentage"):
            apply(column(spark, [bad]), q.percent_ratio(F.col("v")))


def test_unknown_period_is_an_error(spark):
    with pytest.raises(Exception, match="unhandled frequency"):
        apply(column(spark, ["MONTHLY"]), q.period_seconds(F.col("v")))


def half_even(value: Fraction) -> int:
    return round(value)


def model_bar(filled, suspend, stop):
    cells = list(("▓" * filled).ljust(50, "░"))
    for ratio, mark in ((suspend, "⚠️"), (stop, "🛑")):
        if ratio:
            cell = int(ratio * 50)
            if cell < len(cells):
                cells[cell] = mark
            elif cell == len(cells):
                cells.append(mark)
    return "".join(cells)


RATIOS = [None, "0%", "2%", "50%", "98%", "100%", "101%", "102%", "104%", "150%", "199%"]


def test_bars_against_a_list_of_cells(spark):
    used = [0, 1, 3, 49, 50, 99, 100, 101, 103, 150]
    start = datetime(2024, 1, 3, 5, 6, 7, 250000)
    rows = [
        (f"m{u}-{a}-{b}", Decimal(100), Decimal(u), "DAILY" if u % 2 else "WEEKLY", start, a, b)
        for u in used for a in RATIOS for b in RATIOS
    ]
    frame = spark.createDataFrame(
        rows,
        "name string, credit_quota decimal(18,2), used_credits decimal(18,2), frequency string,"
        " start_time timestamp_ntz, suspend_at string, suspend_immediately_at string",
    )
    as_of = datetime(2024, 2, 1, 13, 30, 1)
    found = {r["name"]: r for r in quota_figures(frame, as_of).collect()}

    def ratio(text):
        return Fraction(text.rstrip("%")) / 100 if text else None

    for name, _, used_credits, frequency, begun, a, b in rows:
        period = timedelta(days=1 if frequency == "DAILY" else 7)
        phase = (as_of - begun) % period
        time_filled = half_even(Fraction(phase // timedelta(microseconds=1), period // timedelta(microseconds=1)) * 50)
        assert found[name]["credit_bar"] == model_bar(half_even(Fraction(used_credits) / 100 * 50), ratio(a), ratio(b)), name
        assert found[name]["time_bar"] == model_bar(time_filled, ratio(a), ratio(b)), name


def test_quota_status_text_and_message(spark):
    frame = spark.createDataFrame(
        [("w", Decimal("10"), Decimal("2.345"), "WEEKLY", datetime(2024, 1, 1), None, "100%")],
        "name string, credit_quota decimal(18,3), used_credits decimal(18,3), frequency string,"
        " start_time timestamp_ntz, suspend_at string, suspend_immediately_at string",
    )
    report = quota_report(frame, datetime(2024, 1, 4))
    lines = report.first()["status"].split("\n")
    assert lines[:6] == [
        "Resource Monitor Name: w", "Monitor Frequency: WEEKLY", "Frequency Start Time: 2024-01-01 00:00:00",
        "Credit Limit: 10.00", "Credits Consumed: 2.34", "Suspend Immediately At: 10.00",
    ]
    assert lines[6] == "Time:" and lines[8] == "Credits:" and lines[10] == "-" * 50
    message = [r["value"] for r in quota_message(report, "dev").collect()]
    assert message[0].startswith("dev Environment Resource Monitor Status Report:")


def test_phase_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = spark.createDataFrame([(0, datetime(2024, 3, 9, 12))], "i int, v timestamp_ntz")
        found = apply(frame, q.phase_micros(F.col("v"), F.lit("2024-03-11 13:00:00").cast("timestamp_ntz"), F.lit("DAILY")))
        assert found == [3_600_000_000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_failure_report_is_whole_unless_a_limit_is_given(spark):
    rows = [("pc", f"t{i:03d}", "RAW", f"x\n{'e' * (i % 40)}") for i in range(400)] + [("bc", "t", None, "one")]
    frame = spark.createDataFrame(rows, "core_center string, table_name string, procedure_name string, error_message string")
    found = {r["core_center"]: r for r in failure_report(frame).collect()}
    for center in ("pc", "bc"):
        blocks = [
            f"Table Name: {t}\nProcedure Name: {p}\nException: {m.splitlines()[-1]}\n\n{'*' * 56}"
            for c, t, p, m in rows if c == center
        ]
        assert found[center]["notice"] == "\n\n\n".join(blocks)
        assert found[center]["entry_count"] == len(blocks)
    cut_off = {r["core_center"]: r["notice"] for r in failure_report(frame, limit=1500).collect()}
    assert cut_off == {center: row["notice"][:1500] for center, row in found.items()}


def test_a_report_is_gathered_in_bounded_parts_and_cut_in_the_map_tasks(spark):
    rows = [(None if i % 9 == 0 else "pc", f"t{i // 2:05d}", None, f"m{i}") for i in range(4000)]
    frame = spark.createDataFrame(rows, "core_center string, table_name string, procedure_name string, error_message string")
    whole = {r["core_center"]: r for r in failure_report(frame).collect()}
    parts = sorted(failure_report(frame, parts=True).collect(), key=lambda r: r["part_no"])
    assert max(r["entry_count"] for r in parts) == 1000
    for center in ("pc", None):
        mine = [r for r in parts if r["core_center"] == center]
        assert SEPARATOR.join(r["notice"] for r in mine) == whole[center]["notice"]
        assert sum(r["entry_count"] for r in mine) == whole[center]["entry_count"]
    for limit in (0, 1500, 9000):
        short = failure_report(frame, limit=limit)
        assert {r["core_center"]: r["notice"] for r in short.collect()} == {c: r["notice"][:limit] for c, r in whole.items()}
        assert limit == 9000 or "WindowGroupLimit" in plan_of(short)


def test_blocks_that_are_null_count_and_show_nowhere(spark):
    frame = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, "y"), ("b", 1, None)], "g string, k int, t string")
    for limit in (None, 100):
        got = {r["g"]: (r["entry_count"], r["notice"]) for r in notices(frame, "g", ["k"], F.col("t"), limit).collect()}
        assert got == {"a": (3, "x" + SEPARATOR + "y"), "b": (1, "")}


def test_run_state():
    assert run_state(0, False, False, 0) == "disabled"
    assert run_state(0, True, False, 0) == "no_work"
    assert run_state(3, True, True, 1) == "failure"
    assert run_state(3, True, True, 0) == "success"


def test_notices_work_out_their_entries_once(spark):
    worked_out = spark.sparkContext.accumulator(0)

    def entry(i):
        worked_out.add(1)
        return (f"g{i % 2}", i, None if i % 5 == 0 else f"t{i}")

    # The shuffle before the range slices, which sample what they are given.
    entries = spark.createDataFrame(spark.sparkContext.range(40, numSlices=2).map(entry), "g string, k int, t string").repartition(3)
    found = {r["g"]: (r["entry_count"], r["notice"]) for r in notices(entries, "g", ["k"], F.col("t")).collect()}
    assert found == {f"g{n}": (20, SEPARATOR.join(f"t{i}" for i in range(n, 40, 2) if i % 5)) for n in (0, 1)}
    assert worked_out.value == 40


def test_names_match_as_with_ilike(spark):
    patterns = [*BLOCKED_PATTERNS, r"a\%b_", "x.y%", r"back\\slash", ""]
    names = [
        "PC_TMP1", "pcXtmp", "pct_1", "pcta", "pcst", "pcst_", "pcstx", "xx_", "xxy", "CC_a\nworkitem", "cc_workitem\n", "A%bc", "aXbc",
        "x.yz", "xay", "back\\slash", "", "\n", "zpct_1", "bcst_\n", "pc_Workitem", None,
    ]
    frame = spark.createDataFrame([(n,) for n in names], "v string")
    either = F.lit(False)
    for pattern in patterns:
        either = either | F.col("v").ilike(pattern)
    rows = frame.select(matches_any(F.col("v"), patterns).alias("a"), either.alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows] and {r["a"] for r in rows} == {True, False, None}
    assert not frame.where(matches_any(F.col("v"), [])).count()

"""Incremental scoring after corrections of every kind equals scoring everything anew."""

import datetime as dt

from panelspark.plans import outbreak
from panelspark.sources.tables import Tables

D = dt.date
SCHEMA = (
    "report_id int, country_iso3c string, disease string, is_aquatic boolean, start_date date,"
    " last_report_date date, resolved_date date, endemic boolean"
)
RESULTS = (outbreak.PREDICTIONS, outbreak.BY_ORIGIN, outbreak.STATUS, outbreak.REJECTED, outbreak.KEYS)


def report(i, country, disease, month=1, resolved=2, aquatic=False):
    day = D(2020, month, 5)
    return (i, country, disease, aquatic, day, day, resolved and D(2020, resolved, 20), False)


def model(spark):
    names = ["pox", "flu", "rare", "dull", "fish"]
    known = [(n, n) for n in names] + [("goat pox", "pox")]
    return dict(
        names=spark.createDataFrame(known, "disease_name string, disease_standard string"),
        taxa=spark.createDataFrame([(n, n != "dull") for n in names], "disease string, disease_primary_taxa boolean"),
        coefficients=spark.createDataFrame(
            [(n, "trade_from_outbreaks", 0.5) for n in names if n != "fish"],
            "disease string, variable string, coef double",
        ),
        scaling=spark.createDataFrame([("trade_from_outbreaks", 0.0, 1.0)], "variable string, mean double, sd double"),
        edges=spark.createDataFrame(
            [(o, t, 2020, float(ord(o) + 2 * ord(t))) for o in "ABCD" for t in "ABCD" if (o, t) not in {("A", "C"), ("A", "A")}],
            "country_origin string, country_destination string, year int, trade double",
        ),
        weights=["trade"], tag="v1", as_of=D(2020, 5, 1), since=D(2020, 1, 1),
    )


BEFORE = [
    report(1, "A", "pox"), report(2, "B", "pox"), report(3, "B", "flu", 2, None), report(4, "C", "flu"),
    report(5, "A", "Goat Pox", 3, 4), report(6, "D", "rare"), report(7, "A", "dull"), report(8, "B", "unheard"),
    report(9, "C", "pox", 1, 1), report(10, "D", "flu", 4, None), report(11, "A", "fish"), report(12, "D", "pox", 2, 3),
    report(13, "B", "flu"),
]
# each step: the reports that come in, new ones and corrected ones
STEPS = [
    [
        report(1, "A", "flu"),  # another disease; its old key keeps a report under another raw name
        report(4, "D", "flu", 2, 3),  # another country; the old key is left without a report
        report(9, "C", "pox", 1, 1, aquatic=True),  # leaves as aquatic
        report(10, "D", "flu", 4, 4),  # resolved
        report(14, "A", "rare", 3, None),  # the disease comes to a second country
        report(8, "B", "dull"),  # was unrecognized, now of other taxa
        report(15, "C", "unheard of"),
    ],
    [
        report(14, "A", "pox", 3, None),  # and is left in one again
        report(15, "C", "fish"),
        report(9, "C", "pox", 2, 3),  # comes back
        report(13, "A", "flu", 4, None),
        report(5, "D", "flu"),  # a raw name with blanks and capitals goes
    ],
]


def test_incremental_equals_full(spark, tmp_path, rows):
    given = model(spark)
    tables = Tables(spark, str(tmp_path / "step"))
    events = {r[0]: r for r in BEFORE}
    frame = lambda rs: spark.createDataFrame(list(rs), SCHEMA)
    tables.upsert(outbreak.EVENTS, frame(BEFORE), ["report_id"], changes=True)
    outbreak.score(tables, None, None, **given)
    for number, step in enumerate(STEPS):
        new = frame(step)
        tables.upsert(outbreak.EVENTS, new, ["report_id"], changes=True)
        replaced = tables.before(outbreak.EVENTS)
        assert {r["report_id"] for r in replaced.collect()} == {r[0] for r in step} & set(events)
        if number:  # without the feed the earlier versions are looked up in the history
            outbreak.score(tables, new, frame(events.values()), **given)
        else:
            outbreak.score(tables, new, None, replaced=replaced, **given)
        events.update((r[0], r) for r in step)
        whole = Tables(spark, str(tmp_path / f"whole{number}"))
        outbreak.score(whole, None, frame(events.values()), **given)
        for name in RESULTS:
            assert rows(tables.read(name)) == rows(whole.read(name)), (number, name)
        seen = {(r["country_iso3c"], r["disease"]) for r in tables.read(outbreak.PREDICTIONS).collect()}
        assert ("A", "pox") in seen and ("C", "flu") not in seen
        assert (("A", "rare") in seen) == (("D", "rare") in seen) == (number == 0)
        assert (("C", "pox") in seen) == (number == 1)


def test_a_small_change_reads_and_writes_few_buckets(spark, tmp_path):
    given = model(spark)
    tables = Tables(spark, str(tmp_path / "t"), buckets=32)
    many = [report(i, "ABCD"[i % 4], ("pox", "flu")[i % 2], 1 + i % 4, 1 + i % 4) for i in range(40)]
    tables.upsert(outbreak.EVENTS, spark.createDataFrame(many, SCHEMA), ["report_id"], changes=True)
    outbreak.score(tables, None, None, **given)
    files = {n: set(tables.read(n).inputFiles()) for n in (outbreak.PREDICTIONS, outbreak.BY_KEY, outbreak.STATUS)}
    new = spark.createDataFrame([report(100, "A", "pox", 5, 5)], SCHEMA)
    outbreak.score(tables, new, None, replaced=new.limit(0), **given)
    assert {r["month"].month for r in tables.read(outbreak.TOUCHED).collect()} == {5}
    for name, old in files.items():
        left = old & set(tables.read(name).inputFiles())
        assert len(old) - len(left) <= 2 < len(left), name

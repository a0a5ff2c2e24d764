"""Features kept up to date month by month, against a rebuild."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from meterflow.operators import features
from meterflow.streaming import ingest, maintained

PANEL = (
    "consumer_no long, ord int, month_end date, consumption_unit double, bill_amount double, payment_amount double, closing_arrears double, contract_load double, "
    "payment_date date, due_date date, connection_date date, payment_blank boolean, tarrif string, solar_consumer string"
)
FIRST, LAST = 24000, 24017


def months(seed=3):
    """Consumers that come, go and pause, with missing and negative values."""
    draw, out = random.Random(seed), []
    for c in range(12):
        begin = draw.randrange(FIRST, FIRST + 6) if c else FIRST
        for ord in range(begin, LAST + 1):
            if c > 2 and draw.random() < 0.25 or c == 1 and 24003 < ord < 24016:
                continue
            day = datetime.date(ord // 12, ord % 12 + 1, 28)
            unit = draw.choice([None, -1.0, 5.0, 7.0, 1e9 + draw.random(), draw.uniform(0, 300), draw.uniform(0, 300)])
            paid = draw.choice([None, day, day.replace(day=3)])
            out.append((c, ord, day, unit, draw.uniform(1, 90), draw.uniform(0, 90), draw.choice([None, draw.uniform(0, 9)]), 2.0, paid, day.replace(day=10), datetime.date(1999, 1, 1), paid is None, "A", "N"))
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, PANEL).repartition(3)


def values(df):
    names = ["consumer_no", "ord", *features.HISTORY, "prior_count", "prior_mean", "prior_std", "recent_mean_3", "recent_std_3", "payment_ratio_mean3", "arrears_trend", "rule_z_current", "anomaly_current", *features.NEXT, "at_risk_current", "tenure_months", "target_ord"]
    return {(r[0], r[1]): tuple(r[2:]) for r in df.select(*names).collect()}


def same(have, want):
    assert have.keys() == want.keys()
    for key in want:
        for a, b in zip(have[key], want[key], strict=True):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-6, abs=1e-6)), key


def test_every_month_gives_what_a_rebuild_gives(spark, tmp_path):
    rows, home = months(), str(tmp_path / "home")
    begun = FIRST + 12
    maintained.begin(table(spark, [r for r in rows if r[1] <= begun]), home)
    same(values(maintained.maintained(spark, home)), values(features.build_features(table(spark, [r for r in rows if r[1] <= begun]))))
    for ord in range(begun + 1, LAST + 1):
        assert maintained.advance(table(spark, [r for r in rows if r[1] == ord]), home)
        same(values(maintained.maintained(spark, home)), values(features.build_features(table(spark, [r for r in rows if r[1] <= ord]))))
    # The state holds no month that is out of reach, and only the last two states are kept.
    state = spark.read.parquet(f"{home}/state/ord={LAST}")
    assert state.select(F.min(F.expr("array_min(transform(recent, m -> m.ord))"))).first()[0] == LAST - maintained.REACH + 1
    assert sorted(p.name for p in (tmp_path / "home" / "state").iterdir()) == [f"ord={LAST - 1}", f"ord={LAST}"]


def test_a_month_reads_itself_and_the_state_only(spark, tmp_path, monkeypatch):
    rows, home, read = months(), str(tmp_path / "home"), []
    maintained.begin(table(spark, [r for r in rows if r[1] < LAST]), home)
    for name in ("_with_history", "next_state"):
        made = getattr(maintained, name)
        monkeypatch.setattr(maintained, name, lambda *a, made=made: read.append(made(*a)) or read[-1])
    maintained.advance(table(spark, [r for r in rows if r[1] == LAST]), home)
    assert len(read) == 2
    for df in read:
        files = df.inputFiles()
        own = [f for f in files if "/home/" in f]
        assert own and all(f"/home/state/ord={LAST - 1}/" in f for f in own) and all("/arrived-" in f for f in files if f not in own)


def test_what_does_not_follow_is_refused_and_a_replay_changes_nothing(spark, tmp_path):
    rows, home = months(), str(tmp_path / "home")
    month = lambda ord: [r for r in rows if r[1] == ord]
    maintained.begin(table(spark, [r for r in rows if r[1] < LAST - 1]), home)
    for bad in ([], month(LAST), month(LAST - 1) + month(LAST), month(LAST - 1) + month(LAST - 1)[:1], month(LAST - 2)):
        with pytest.raises(ValueError):
            maintained.advance(table(spark, bad), home)
    assert maintained.advance(table(spark, month(LAST - 1)), home)
    before = values(maintained.maintained(spark, home))
    assert not maintained.advance(table(spark, month(LAST - 1)[::-1]), home)
    with pytest.raises(ValueError):
        maintained.advance(table(spark, month(LAST - 1)[1:]), home)
    assert values(maintained.maintained(spark, home)) == before
    with pytest.raises(ValueError):
        maintained.begin(table(spark, rows), home)


def test_a_month_that_broke_off_is_taken_in_again(spark, tmp_path, monkeypatch):
    rows, home = months(), str(tmp_path / "home")
    maintained.begin(table(spark, [r for r in rows if r[1] < LAST]), home)
    before = values(maintained.maintained(spark, home))
    with monkeypatch.context() as patch:
        patch.setattr(maintained, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            maintained.advance(table(spark, [r for r in rows if r[1] == LAST]), home)
    assert values(maintained.maintained(spark, home)) == before
    assert maintained.advance(table(spark, [r for r in rows if r[1] == LAST]), home)
    same(values(maintained.maintained(spark, home)), values(features.build_features(table(spark, rows))))


def test_batches_are_checked_against_the_list_of_periods(spark, tmp_path):
    out, seen = str(tmp_path / "out"), []
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "consumer_no long, ord int")
    then = lambda month, ord: seen.append((ord, month.count()))
    ingest.append_periods(rows((1, 5), (2, 5), (1, 6)), 0, out, then=then)
    for bad in (rows((1, 7), (1, 7)), rows((1, 6)), rows((1, 8)), rows((1, 7), (1, 9))):
        with pytest.raises(ValueError):
            ingest.append_periods(bad, 1, out)
    ingest.append_periods(rows((1, 7)), 1, out, then=then)
    # The same batch again, as after a lost driver.
    ingest.append_periods(rows((1, 7)), 1, out, then=then)
    ingest.append_periods(rows((1, 1)).limit(0), 2, out)
    assert seen == [(5, 2), (6, 1), (7, 1), (7, 1)]
    assert sorted(map(tuple, spark.read.parquet(out).select("consumer_no", "ord").collect())) == [(1, 5), (1, 6), (1, 7), (2, 5)]
    assert sorted(map(tuple, ingest.arrivals(spark, out).collect())) == [(0, 5, 2), (0, 6, 1), (1, 7, 1)]


def test_a_month_begins_in_one_file(spark, tmp_path, monkeypatch):
    """Every task wrote a file for each of its months."""
    monkeypatch.setattr(maintained, "materialize", lambda df, label: df.repartition(4))
    maintained.begin(table(spark, months()), str(tmp_path / "home"))
    for name in ("features", "targets"):
        folders = list((tmp_path / "home" / name).glob("ord=*"))
        assert len(folders) == LAST - FIRST + 1 and all(len(list(f.glob("*.parquet"))) == 1 for f in folders)

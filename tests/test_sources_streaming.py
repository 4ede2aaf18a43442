"""XML / CSV sources, market partitions, registry, streaming = batch."""

import os
import tempfile

from pyspark.sql import functions as F

import xml_fixtures
from bidscope.sources.notifications import read_notifications
from bidscope.sources.tables import read_markets, read_offers_csv, write_markets
from bidscope.streaming import notifications as S


def _tree():
    root = tempfile.mkdtemp(prefix="bidscope-xml-")
    exp = xml_fixtures.write_tree(root)
    return root, exp


def test_xml_batch(spark):
    root, exp = _tree()
    offers, q = read_notifications(spark, root)
    rows = offers.collect()
    assert len(rows) == exp["good_rows"]
    assert {r["CompetitionName"] for r in q.collect()} == exp["bad"]
    by = {(r["CompetitionName"], r["SellerId"]): r for r in rows}
    first = by[("good1", "S1")]
    assert first["IsCustomer"] == 1 and first["ConditionNotes"] == 1 and first["IsBuyBoxWinner"] == -1
    assert abs(first["Time"] - 33924868.123) < 1e-6
    missing = by[("good1", "S3")]
    assert missing["ListingPrice"] == -1 and missing["ShippingTime_maxHours"] == -1
    assert missing["ShippingTime_availtype"] == ""
    assert by[("good1", "A1X6FK5RDHNB96")]["IsBuyBoxWinner"] == 1


def test_stream_equals_batch(spark):
    root, exp = _tree()
    offers, _ = S.stream_notifications(spark, root)
    q = (offers.writeStream.format("memory").queryName("xml_stream_rows")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="bidscope-ck-"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.table("xml_stream_rows")
    batch, _ = read_notifications(spark, root)
    assert got.count() == exp["good_rows"]
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_stream_running_min_and_dedup(spark):
    root, _ = _tree()
    offers, _ = S.stream_notifications(spark, root)
    ev = S.with_event_time(offers)
    ded = S.dedup_notifications(ev.unionByName(ev))
    q1 = (ded.writeStream.format("memory").queryName("dedup_rows").outputMode("append")
          .option("checkpointLocation", tempfile.mkdtemp(prefix="bidscope-ck-"))
          .trigger(availableNow=True).start())
    q1.awaitTermination(120)
    assert spark.table("dedup_rows").count() == 5
    mins = S.running_product_min(offers)
    q2 = (mins.writeStream.format("memory").queryName("prod_min").outputMode("complete")
          .option("checkpointLocation", tempfile.mkdtemp(prefix="bidscope-ck-"))
          .trigger(availableNow=True).start())
    q2.awaitTermination(120)
    got = {r["ProductId"]: r["min_landed"] for r in spark.table("prod_min").collect()}
    assert got == {"P1": -2.0}


def test_csv_permissive_and_markets(spark, offers):
    d = tempfile.mkdtemp(prefix="bidscope-csv-")
    path = os.path.join(d, "offers.csv")
    from bidscope.schema import OFFER_SCHEMA
    header = ",".join(f.name for f in OFFER_SCHEMA.fields)
    good = "1,M1,P1,S1,0,1,1,10.0,2.0,48,24,NOW,1,FR,,98,10,new,1,1.5,C1"
    with open(path, "w") as fh:
        fh.write("\n".join([header, good, good + ",extra,fields", "1,M1,P1", '1,"M,1,2,3","P,,,,,,,,,,,,,,,,,,,,1"',
                            "1,M1,P1,S1,0,1,1,cheap"]) + "\n")
    ok, bad = read_offers_csv(spark, path)
    assert sorted(r["MarketplaceId"] for r in ok.collect()) == ["M,1,2,3", "M1", "M1"]
    assert sorted(r["line"].rsplit(",", 1)[1] for r in bad.collect()) == ["cheap", "fields"]
    out = os.path.join(d, "markets")
    sizes = write_markets(offers.drop("l_shipdate", "auction_time"), out)
    back = read_markets(spark, out)
    assert back.count() == offers.count()
    assert sizes.where(F.col("MarketplaceId").isNull()).first()["n_rows"] == offers.count()
    one = back.select("MarketplaceId").first()[0]
    assert read_markets(spark, out, [one]).select("MarketplaceId").distinct().count() == 1


def test_recommend_stream_writes_each_batch_once(spark):
    """T4: each micro-batch of new notifications is repriced with the batch operators and committed
    once, also when it is replayed after a crash before or after the commit."""
    from bidscope.operators import reprice as RP
    from bidscope.streaming.tables import EpochTable
    root, _ = _tree()
    out = tempfile.mkdtemp(prefix="bidscope-rec-")
    offers, _ = S.stream_notifications(spark, root, 1)
    batch, _ = read_notifications(spark, root)
    want = RP.reprice(batch, batch, degree=1)
    table = EpochTable(spark, out, want.schema)
    run = lambda state: S.recommend_stream(offers, table, state, history=batch, degree=1).awaitTermination(180)
    state = tempfile.mkdtemp(prefix="bidscope-ck-")
    run(state)
    assert {r["File"] for r in table.read().collect()} == {"good1", "good2"}
    assert table.read().exceptAll(want).count() == 0 and table.read().count() == want.count()
    assert table.last_epoch() >= 1
    run(state)                                              # nothing new
    run(tempfile.mkdtemp(prefix="bidscope-ck-"))            # all epochs again, the stream's own state lost
    assert table.read().count() == want.count()


def test_epoch_table_survives_crashes_and_replays(spark, monkeypatch):
    import pytest
    from bidscope.streaming import tables
    root = tempfile.mkdtemp(prefix="bidscope-epochs-")
    rows = lambda *x: spark.createDataFrame(x, "k string, v long")
    table = lambda: tables.EpochTable(spark, root, rows(("a", 1)).schema, ["k"], compact_every=3)
    state = lambda: {r["k"]: r["v"] for r in table().read().collect()}
    assert state() == {}
    assert table().write(rows(("a", 5), ("b", 6)), 0)
    assert not table().write(rows(("a", 99)), 0)            # replayed after its commit
    with monkeypatch.context() as m:                        # crash between the files and the commit
        m.setattr(tables.ManifestLog, "update", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            table().write(rows(("a", 4)), 1)
    assert state() == {"a": 5, "b": 6}
    assert table().write(rows(("a", 4), ("c", 1)), 1)       # the same epoch again, in a new process
    assert state() == {"a": 4, "b": 6, "c": 1}
    for e in range(2, 9):
        assert table().write(rows(("c", 1 - e)), e)
    assert state() == {"a": 4, "b": 6, "c": -7}
    folders = [f for f in os.listdir(root) if f.startswith(("epoch=", "to="))]
    table().sweep()
    left = [f for f in os.listdir(root) if f.startswith(("epoch=", "to="))]
    assert len(left) <= 4 < len(folders) and state() == {"a": 4, "b": 6, "c": -7}


def test_running_minimum_writes_changed_keys_only(spark):
    """T3 to a table: the second run of the stream writes the keys of the new file only."""
    from bidscope.streaming.tables import EpochTable
    landing, root, ck = (tempfile.mkdtemp(prefix="bidscope-t3-") for _ in range(3))
    rows = lambda *x: spark.createDataFrame(x, "ProductId string, ListingPrice double, ShippingPrice double")
    stream = S.running_product_min(spark.readStream.schema(rows(("a", 1.0, 0.0)).schema).parquet(landing))
    table = EpochTable(spark, root, stream.schema, ["ProductId"])
    rows(("a", 9.0, 1.0), ("b", 5.0, 0.5), ("a", 8.0, 1.0)).coalesce(1).write.mode("append").parquet(landing)
    S.upsert_stream(stream, table, ck).awaitTermination(120)
    assert {tuple(r) for r in table.read().collect()} == {("a", 9.0, 2), ("b", 5.5, 1)}
    rows(("b", 7.0, 0.0), ("c", 2.0, 2.0)).coalesce(1).write.mode("append").parquet(landing)
    S.upsert_stream(stream, table, ck).awaitTermination(120)
    assert {tuple(r) for r in table.read().collect()} == {("a", 9.0, 2), ("b", 5.5, 2), ("c", 4.0, 1)}
    newest = max((f for f in os.listdir(root) if f.startswith("epoch=")), key=lambda f: int(f.split("=")[1].split("-")[0]))
    assert {r["ProductId"] for r in spark.read.parquet(f"{root}/{newest}").collect()} == {"b", "c"}


def test_of_two_writers_one_starts_again(spark):
    """Two writers who read one state: the second is refused, none is lost, readers see whole states."""
    import pytest
    from concurrent.futures import ThreadPoolExecutor
    from bidscope.sources.manifests import Conflict, ManifestLog
    log = ManifestLog(spark, tempfile.mkdtemp(prefix="bidscope-log-"))
    assert log.latest() == 0 and log.read() == []
    log.commit(1, ["a", "é b"])
    with pytest.raises(Conflict):
        log.commit(1, ["other"])
    assert log.read() == ["a", "é b"]
    assert not log.update(lambda rows: None)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: log.update(lambda rows: [*rows, f"w{i}"]), range(20)))
    assert sorted(log.read()) == sorted(["a", "é b", *(f"w{i}" for i in range(20))]) and log.latest() == 21


def test_writers_round_trip_and_guard(spark, offers):
    """S5, S8, S11-S13."""
    import pytest
    from bidscope.sources import tables as T
    d = tempfile.mkdtemp(prefix="bidscope-out-")
    small = offers.select("MarketplaceId", "CompetitionName", "ListingPrice").limit(200)
    T.write_offers(small, f"{d}/offers")
    T.write_offers(small, f"{d}/csv", fmt="csv")
    back = T.read_table(spark, f"{d}/offers")
    assert back.exceptAll(small).count() == 0 and back.count() == 200
    assert spark.read.option("header", True).csv(f"{d}/csv").count() == 200
    T.write_feature_frame(small, f"{d}/frame")
    assert T.read_markets(spark, f"{d}/frame").count() == 200
    T.write_table(small, f"{d}/table")
    with pytest.raises(ValueError):
        T.write_table(T.read_table(spark, f"{d}/table"), f"{d}/table")


def test_files_that_were_read_are_not_read_again(spark):
    """S1 with a ledger: the second run reads the new files only, the third none."""
    from bidscope.sources.notifications import NotificationLedger
    import shutil
    root, _ = _tree()
    ledger = NotificationLedger(spark, root, tempfile.mkdtemp(prefix="bidscope-ledger-"))
    offers, bad, files = ledger.read_new()
    want, want_bad = read_notifications(spark, root)
    assert offers.exceptAll(want).count() == 0 and offers.count() == want.count() and bad.count() == want_bad.count()
    n = files.count()
    assert n > 2 and ledger.commit(files)
    offers, _, files = ledger.read_new()
    assert files.count() == 0 and offers.count() == 0 and not ledger.commit(files)
    one = next(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f == "good1.xml")
    shutil.copy(one, one.replace("good1", "good9"))
    offers, _, files = ledger.read_new()
    assert [r["path"].rsplit("/", 1)[1] for r in files.collect()] == ["good9.xml"]
    assert {r[0] for r in offers.select("CompetitionName").distinct().collect()} == {"good9"}
    assert {f.rsplit("/", 1)[1] for f in offers.inputFiles()} == {"good9.xml"}
    assert ledger.commit(files) and ledger.new_files().count() == 0


def test_table_by_auction_needs_no_exchange(spark, offers):
    """S8 by auction: windows of the auction read the stored frame without a shuffle."""
    from bidscope.operators import features as W
    from bidscope.operators.reprice import auction_context
    from bidscope.functions.scalars import landed_price
    from bidscope.sources import tables as T
    name, path = "offers_by_auction", tempfile.mkdtemp(prefix="bidscope-buckets-")
    T.write_by_auction(offers, name, 6, f"{path}/t")
    try:
        stored = spark.table(name)
        assert stored.count() == offers.count() and len([f for f in os.listdir(f"{path}/t") if f.endswith(".parquet")]) <= 6
        for df in (W.auction_features(landed_price(stored), with_platform=False), auction_context(stored),
                   stored.groupBy("CompetitionName").count()):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        a, b = (auction_context(x).select("l_orderkey", "l_linenumber", "lo", "hi", "mid") for x in (stored, offers))
        assert a.exceptAll(b).count() == 0
    finally:
        spark.sql(f"drop table if exists {name}")


def test_sketches_of_parts_add_up(spark, offers):
    from bidscope.operators import metrics as A
    cols = ["CompetitionName", "SellerId"]
    kept = A.distinct_sketches(offers, cols, ["MarketplaceId"])
    got = {r["column"]: r["n_distinct"] for r in A.union_distinct(kept).collect()}
    whole = {r["column"]: r["n_distinct"] for r in A.union_distinct(A.distinct_sketches(offers, cols)).collect()}
    exact = A.distinct_count(offers, cols).first()
    for c in cols:
        n = exact[f"distinct_{c}"]
        assert abs(got[c] - n) <= 4 * A.HLL_ERROR / 64 * n and abs(whole[c] - n) <= 4 * A.HLL_ERROR / 64 * n
    per = A.union_distinct(kept, ["MarketplaceId"])
    assert per.count() == 2 * offers.select("MarketplaceId").distinct().count()

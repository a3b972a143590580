import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from pricehouse.client import PriceClient
from pricehouse.plans.exchange_update import update_exchanges
from pricehouse.plans import load as load_module
from pricehouse.plans.load import bulk_load, load, load_folder, retry_failed, validate_only
from pricehouse.plans.store import Store, publish, read_published, refresh_all, seed
from pricehouse.sources.lists import read_symbol_list, write_load_errors, write_symbol_list
from pricehouse.streaming.stream_load import stream_load

HEAD = "Date,Open,High,Low,Close,Volume,Adj Close\n"
T1 = datetime(2024, 2, 1, tzinfo=timezone.utc)
T2 = datetime(2024, 2, 2, tzinfo=timezone.utc)


def bars(start, n, base=100.0):
    return "".join(
        f"2024-01-{start + i:02d},{base + i},{base + i + 2},{base + i - 1},{base + i + 1},{1000 + i},{base + i}\n"
        for i in range(n)
    )


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "house"))
    seed(s)
    return s


def results(df):
    return {r["symbol"]: r.asDict() for r in df.collect()}


def test_seed_is_repeatable(store):
    first = {r["source_name"]: r["source_id"] for r in store.read("data_source").collect()}
    seed(store)
    again = {r["source_name"]: r["source_id"] for r in store.read("data_source").collect()}
    assert first == again and sorted(again.values()) == list(range(1, 13))
    assert store.read("asset").count() == 15


def test_load_one_file_end_to_end(spark, store, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    bad = "2024-01-20,10,9,8,9,5,9\n2024-01-21,abc,9,8,9,5,9\n"
    (folder / "AAPL_test.csv").write_text(HEAD + bars(1, 10) + bad)
    out = results(load(store, str(folder), "MANUAL_CSV", now=T1))
    assert out["AAPL"]["outcome"] == "loaded" and out["AAPL"]["records_loaded"] == 10
    batch = store.read("batch_meta").collect()[0]
    assert (batch["status"], batch["row_count"], batch["batch_id"]) == ("SUCCESS", 10, 1)
    assert batch["file_size_bytes"] == (folder / "AAPL_test.csv").stat().st_size
    assert batch["batch_name"] == "AAPL_test_20240201_000000"
    gold = read_published(spark, store.path("price_gold"))
    assert gold.count() == 10
    assert gold.where("symbol = 'AAPL' and exchange = 'NASDAQ' and asset_type = 'STOCK'").count() == 10
    client = PriceClient(store)
    assert client.prices(["aapl"], "2024-01-03", "2024-01-05").count() == 3
    assert client.prices([], "2024-01-03", "2024-01-05").count() == 0
    assert tuple(client.health().first()) == (15, 10, 1, date(2024, 1, 10))
    assert client.status().first()["row_count"] == 10
    assert [r["price_date"] for r in client.latest_prices().collect()] == [date(2024, 1, 10)]
    summary = client.price_summary("AAPL", 3, "2024-01-10").first()
    assert (summary["trading_days"], summary["latest_price"], summary["avg_volume"]) == (4, 110.0, 1007)
    assert client.price_summary("NONE").count() == 0
    with pytest.raises(ValueError):
        client.price_summary("AAPL", 400)
    assert client.freshness().first()["is_fresh"]
    assert client.recent_price_changes("2024-01-10", 5).count() == 5
    assert client.available_symbols("CRYPTO", "CRYPTO").count() == 4
    assert client.sources().count() == 12 and client.recent_batches().count() == 1
    # a second load of changed bars replaces the old ones, raw keeps both
    (folder / "AAPL_test.csv").write_text(HEAD + bars(5, 3, 200.0) + bars(5, 1, 300.0))
    load(store, str(folder), "MANUAL_CSV", min_score=0, now=T2)
    assert store.read("price_raw").count() == 14
    gold = {r["price_date"]: r["close_price"] for r in read_published(spark, store.path("price_gold")).collect()}
    assert len(gold) == 10
    assert gold[date(2024, 1, 5)] == 301 and gold[date(2024, 1, 6)] == 202 and gold[date(2024, 1, 1)] == 101


def test_gate_dry_run_and_several_symbols(spark, store, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "LOW.csv").write_text(HEAD + "x,a,b,c,,z,\nx,a,b,c,,z,\n")
    (folder / "TWO.csv").write_text("Symbol," + HEAD + "".join(f"{s},{b}\n" for s in "PQ" for b in bars(1, 3).split()))
    (folder / "OK.csv").write_text(HEAD + bars(1, 3))
    (folder / "NONE.csv").write_text(HEAD)
    files = {r["source_file"].rsplit("/", 1)[1]: r for r in load(store, str(folder), dry_run=True).collect()}
    assert {n: r["outcome"] for n, r in files.items()} == {
        "LOW.csv": "failed", "TWO.csv": "failed", "OK.csv": "valid", "NONE.csv": "failed"}
    assert files["NONE.csv"]["message"] == "the file has no rows"
    assert files["TWO.csv"]["message"] == "it holds several symbols"
    assert store.read("batch_meta").count() == 0
    done = load(store, str(folder), several_symbols="rows", now=T1)
    write_load_errors(done, str(tmp_path / "errors"))
    assert spark.read.json(str(tmp_path / "errors")).count() == 2
    symbols = {r[0] for r in store.read("price_raw").join(store.read("asset"), "asset_id").select("symbol").distinct().collect()}
    assert symbols == {"P", "Q", "OK"}
    report = validate_only(spark, str(folder)).where("source_file like '%OK.csv'").first()
    assert report["passed"] and report["quality_score"] == 100.0 and report["row_count"] == 3


def test_bulk_load_skips_and_retries(spark, store, tmp_path):
    folder = tmp_path / "bulk"
    folder.mkdir()
    for name in ("aaa", "bbb"):
        (folder / f"{name}.csv").write_text(HEAD + bars(1, 4))
    out = results(bulk_load(store, str(folder), now=T1))
    assert {k: v["outcome"] for k, v in out.items()} == {"AAA": "loaded", "BBB": "loaded"}
    (folder / "ccc.csv").write_text(HEAD + bars(1, 4))
    (folder / "ddd.csv").write_text(HEAD + bars(1, 4))
    write_symbol_list(spark.createDataFrame([("CCC",), ("AAA",)], "symbol STRING"), str(tmp_path / "missing"))
    listed = read_symbol_list(spark, str(tmp_path / "missing"))
    out = results(retry_failed(store, str(folder), listed, now=T2))
    assert {k: v["outcome"] for k, v in out.items()} == {"AAA": "skipped", "CCC": "loaded"}
    out = results(bulk_load(store, str(folder)))
    assert {k: v["outcome"] for k, v in out.items()} == {
        "AAA": "skipped", "BBB": "skipped", "CCC": "skipped", "DDD": "loaded"}
    assert read_published(spark, store.path("price_gold")).count() == 16


def test_load_folder_tells_crypto(spark, store, tmp_path):
    folder = tmp_path / "mix"
    folder.mkdir()
    (folder / "doge-usd.csv").write_text(HEAD + bars(1, 2))
    (folder / "ibm.csv").write_text(HEAD + bars(1, 2))
    load_folder(store, str(folder))
    kinds = {r["symbol"]: r["asset_type"] for r in store.read("asset").collect()}
    assert kinds["DOGE"] == "CRYPTO" and kinds["IBM"] == "STOCK"


def test_half_done_load_stays_invisible_and_is_repeated(spark, store, tmp_path, monkeypatch):
    folder = tmp_path / "half"
    folder.mkdir()
    (folder / "zzz.csv").write_text(HEAD + bars(1, 4))
    import pricehouse.operators.loading as loading

    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(loading, "batch_events", die)
    with pytest.raises(RuntimeError):
        bulk_load(store, str(folder), now=T1)
    monkeypatch.undo()
    assert store.read("price_raw").count() == 4 and store.gold().count() == 0
    assert results(bulk_load(store, str(folder), now=T2))["ZZZ"]["outcome"] == "loaded"
    assert store.gold().count() == 4


def test_stream_load_takes_only_new_files(spark, store, tmp_path):
    folder = tmp_path / "live"
    folder.mkdir()
    for name in ("s1", "s2", "s3"):
        (folder / f"{name}.csv").write_text(HEAD + bars(1, 2))
    args = (store, str(folder), str(tmp_path / "ckpt"))
    stream_load(*args, refresh_batch=2).awaitTermination()
    assert store.read("batch_meta").count() == 3
    assert read_published(spark, store.path("price_gold")).count() == 6
    (folder / "s4.csv").write_text("Close,Low,High,Open,Date\n1,1,1,1,2024-01-01\n")
    stream_load(*args, refresh_batch=2).awaitTermination()
    assert store.read("batch_meta").count() == 4
    assert read_published(spark, store.path("price_gold")).count() == 7


def test_refresh_all_reports_failures(spark, tmp_path):
    good = lambda: spark.range(3)
    bad = lambda: spark.range(3).select(F.raise_error(F.lit("no")))
    out = refresh_all(spark, {"bad": (str(tmp_path / "b"), bad), "good": (str(tmp_path / "g"), good)})
    assert {r["mart"]: r["refreshed"] for r in out.collect()} == {"bad": False, "good": True}
    publish(spark, str(tmp_path / "g"), spark.range(5))
    assert read_published(spark, str(tmp_path / "g")).count() == 5


def test_update_exchanges(spark, store, tmp_path):
    paths = {}
    for name, text in {"NYSE": "Symbol\tName\nAAPL \tx\nNA\ty\n", "NASDAQ": "Symbol\tName\naapl\tx\nMSFT\tm\n",
                       "TSX": "Symbol\tName\nGOOGL\tg\n" + "L" * 21 + "\tlong\n"}.items():
        (tmp_path / f"{name}.txt").write_text(text)
        paths[name] = str(tmp_path / f"{name}.txt")
    stats, after = update_exchanges(store, paths, str(tmp_path / "backup"), now=T1)
    s = stats.first()
    assert (s["total_symbols"], s["updated"], s["skipped"], s["stock_symbols"]) == (3, 2, 1, 7)
    assert {r[0]: r[1] for r in after.collect()} == {"NASDAQ": 5, "NYSE": 1, "TSX": 1}
    backup = spark.read.csv(str(tmp_path / "backup" / "exchange_backup_20240201_000000"), header=True)
    assert backup.columns == ["symbol", "exchange"] and backup.count() == 7


@pytest.mark.parametrize("refresh_batch", [1, 2, 100])
def test_stream_load_does_not_depend_on_its_batches(spark, store, tmp_path, refresh_batch):
    for part, start in (("x", 1), ("y", 11)):
        (tmp_path / "two" / part).mkdir(parents=True)
        (tmp_path / "two" / part / "aapl.csv").write_text(HEAD + bars(start, 5))
    stream_load(store, str(tmp_path / "two" / "*"), str(tmp_path / "ckpt"), refresh_batch=refresh_batch).awaitTermination()
    assert read_published(spark, store.path("price_gold")).count() == 10
    (tmp_path / "two" / "y" / "msft.csv").write_text(HEAD + bars(1, 2))
    stream_load(store, str(tmp_path / "two" / "*"), str(tmp_path / "ckpt"), refresh_batch=refresh_batch).awaitTermination()
    assert read_published(spark, store.path("price_gold")).count() == 12


def test_stream_load_reads_a_backlog_once(spark, store, tmp_path, monkeypatch):
    """Five files, two a refresh: staged by one job, three loads in order of arrival, three refreshes."""
    arrived = ["z/aapl", "z/msft", "b/ibm", "a/aapl", "c/ko"]
    for n, name in enumerate(arrived):
        file = tmp_path / "in" / f"{name}.csv"
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(HEAD + bars(1, 2, 100.0 + n) + ("2024-01-09,abc,9,8,9,5,9\n" if name == "b/ibm" else ""))
        os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))
    staged, seen = [], []
    stage, refresh = load_module.stage_csv, Store.refresh_gold

    def staging(spark, paths, *rest):
        staged.append(len(paths))
        return stage(spark, paths, *rest)

    def refreshing(self, *args, **named):
        refresh(self, *args, **named)
        gold = read_published(spark, self.path("price_gold")).where("price_date = '2024-01-01'")
        seen.append({r["symbol"]: float(r["open_price"]) for r in gold.collect()})

    monkeypatch.setattr(load_module, "stage_csv", staging)
    monkeypatch.setattr(Store, "refresh_gold", refreshing)
    query = stream_load(store, str(tmp_path / "in" / "*"), str(tmp_path / "ckpt"), refresh_batch=2, min_score=50.0)
    query.awaitTermination()
    assert staged == [5]
    first = {"AAPL": 100.0, "MSFT": 101.0}
    assert seen == [first, {**first, "AAPL": 103.0, "IBM": 102.0}, {**first, "AAPL": 103.0, "IBM": 102.0, "KO": 104.0}]
    loads = {r["load_seq"]: r["count"] for r in store.read("price_raw").groupBy("load_seq").count().collect()}
    assert loads == {1: 4, 2: 4, 3: 2}
    assert [(r["load_seq"], r["symbol"]) for r in store.read("quarantine").collect()] == [(2, "IBM")]
    assert store.read("batch_meta").where("status = 'SUCCESS'").count() == 5
    assert store.coverage().first()["asset_count"] == 4


def test_failed_append_marks_its_batches(spark, store, tmp_path, monkeypatch):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "aapl.csv").write_text(HEAD + bars(1, 3))

    def die(*_):
        raise RuntimeError("disk full")

    monkeypatch.setattr(Store, "append_raw", die)
    with pytest.raises(RuntimeError):
        bulk_load(store, str(tmp_path / "f"), now=T1)
    monkeypatch.undo()
    batch = store.read("batch_meta").collect()[0]
    assert (batch["status"], batch["error_message"], batch["row_count"]) == ("FAILED", "disk full", 3)


def test_only_a_missing_table_counts_as_empty(spark, store, tmp_path):
    assert Store(spark, str(tmp_path / "new")).read("asset").count() == 0
    broken = tmp_path / "broken" / "asset" / "commits"
    broken.mkdir(parents=True)
    (broken / f"{1:020d}.json").write_text("no json")
    with pytest.raises(Exception):
        Store(spark, str(tmp_path / "broken")).read("asset")


def test_upsert_takes_the_last_given_value_of_each_column(spark, store):
    from pricehouse.operators.loading import upsert_assets

    sent = spark.createDataFrame(
        [("NEW", "STOCK", "Beta Inc", "Alpha", 1), ("NEW", "STOCK", "Acme", "Zeta", 2), ("NEW", "STOCK", None, "Omega", 3)],
        "symbol STRING, asset_type STRING, company_name STRING, sector STRING, n INT",
    )
    row = upsert_assets(store.read("asset"), sent, order="n").where("symbol = 'NEW'").first()
    assert (row["company_name"], row["sector"]) == ("Acme", "Omega")
    row = upsert_assets(store.read("asset"), sent.where("n < 3")).where("symbol = 'NEW'").first()
    assert (row["company_name"], row["sector"]) == ("Beta Inc", "Alpha")


def test_second_load_leaves_other_years_as_they_are(spark, store, tmp_path):
    for year in (2023, 2024):
        (tmp_path / str(year)).mkdir()
        (tmp_path / str(year) / "aapl.csv").write_text(HEAD + bars(1, 4).replace("2024-", f"{year}-"))
    load(store, str(tmp_path / "2023"), "MANUAL_CSV", now=T1)
    load(store, str(tmp_path / "2024"), "MANUAL_CSV", now=T2)
    path = store.path("price_gold")
    files = lambda: {
        y: {f for f in read_published(spark, path).where(f"price_year = {y}").inputFiles() if f"price_year={y}" in f}
        for y in (2023, 2024)
    }
    before = files()
    (tmp_path / "2024" / "aapl.csv").write_text(HEAD + bars(3, 4, 500.0))
    load(store, str(tmp_path / "2024"), "MANUAL_CSV", now=datetime(2024, 2, 3, tzinfo=timezone.utc))
    after = files()
    assert before[2023] == after[2023] and before[2024] != after[2024]
    gold, full = read_published(spark, path), store.gold()
    assert gold.count() == 10 and gold.select(full.columns).exceptAll(full).isEmpty()


def test_writer_that_read_an_older_version_is_refused(spark, store):
    from pricehouse.plans.store import MovedOn

    base = store.version("asset")
    assets = store.read("asset")
    store.write("asset", assets.where("symbol <> 'AAPL'"), base)
    with pytest.raises(MovedOn):
        store.write("asset", assets, base)
    assert store.read("asset").where("symbol = 'AAPL'").isEmpty()


def test_two_writers_between_check_and_commit(spark, store, tmp_path):
    """The second of two writers that read one version is refused, whatever it did before its commit."""
    from pricehouse.plans.commits import Commits, _renamed, create_once, reserve
    from pricehouse.plans.store import MovedOn

    base, assets = store.version("asset"), store.read("asset")
    real = Commits.add

    def late(self, number, content):
        Commits.add = real
        store.write("asset", assets.where("symbol <> 'AAPL'"), base)  # the other writer, after this one's look
        return real(self, number, content)

    Commits.add = late
    try:
        with pytest.raises(MovedOn):
            store.write("asset", assets.where("symbol <> 'MSFT'"), base)
    finally:
        Commits.add = real
    assert {r[0] for r in store.read("asset").select("symbol").collect()} == {r["symbol"] for r in assets.collect()} - {"AAPL"}
    assert create_once(spark, str(tmp_path / "once"), "a") and not create_once(spark, str(tmp_path / "once"), "b")
    assert (tmp_path / "once").read_text() == "a" and sorted(p.name for p in tmp_path.glob("*once*")) == ["once"]
    numbers = [reserve(spark, str(tmp_path / "n"), 3, 5), reserve(spark, str(tmp_path / "n"), 2, 1), reserve(spark, str(tmp_path / "n"), 1, 50)]
    assert numbers == [5, 8, 50]
    jvm = spark._jvm.org.apache.hadoop.fs
    for name in ("x", "y"):
        (tmp_path / name).write_text(name)
    files = jvm.Path(str(tmp_path)).getFileSystem(spark._jsc.hadoopConfiguration())
    assert not _renamed(spark, files, jvm.Path(f"file:{tmp_path}/x"), jvm.Path(f"file:{tmp_path}/y"))
    assert _renamed(spark, files, jvm.Path(f"file:{tmp_path}/x"), jvm.Path(f"file:{tmp_path}/z")) and (tmp_path / "y").read_text() == "y"


def test_year_refreshes_that_interleave(spark, store, tmp_path):
    """Refreshes of different years both stay; one of the same year is worked out again."""
    from pricehouse.plans.commits import Commits

    for year in (2023, 2024):
        (tmp_path / str(year)).mkdir()
        (tmp_path / str(year) / "aapl.csv").write_text(HEAD + bars(1, 4).replace("2024-", f"{year}-"))
        load(store, str(tmp_path / str(year)), "MANUAL_CSV", now=T1)
    (tmp_path / "2024" / "aapl.csv").write_text(HEAD + bars(3, 4, 500.0))
    (tmp_path / "2023" / "aapl.csv").write_text(HEAD + bars(3, 4, 700.0).replace("2024-", "2023-"))
    for year in (2023, 2024):
        load(store, str(tmp_path / str(year)), "MANUAL_CSV", now=T2, refresh=False)
    real = Commits.add
    for other in (2023, 2024):
        before = store.version("price_gold")

        def late(self, number, content):
            Commits.add = real
            store.refresh_gold([other])
            return real(self, number, content)

        Commits.add = late
        try:
            store.refresh_gold([2024])
        finally:
            Commits.add = real
        assert store.version("price_gold") == before + 2
    gold, full = read_published(spark, store.path("price_gold")), store.gold()
    assert gold.count() == 12 and gold.select(full.columns).exceptAll(full).isEmpty()


def test_compaction_reads_no_replaced_bar(spark, store, tmp_path):
    (tmp_path / "c").mkdir()
    for number in range(3):
        (tmp_path / "c" / "aapl.csv").write_text(HEAD + bars(1, 4, 100.0 * number + 100))
        load(store, str(tmp_path / "c"), "MANUAL_CSV", now=T1)
    before = {tuple(r) for r in store.live().collect()}
    assert store.compact() == [2024] and store.compact() == []
    (tmp_path / "c" / "aapl.csv").write_text(HEAD + bars(3, 4, 900.0))
    load(store, str(tmp_path / "c"), "MANUAL_CSV", now=T2)
    assert store.read("price_raw").count() == 16
    folded = list((tmp_path / "house" / "price_raw").glob("load_seq=[123]/*/*.parquet"))
    for file in folded:
        file.write_text("no parquet: whoever opens it fails")
    rows = {r["price_date"].day: r["close_price"] for r in store.live().collect()}
    assert rows == {1: 301, 2: 302, 3: 901, 4: 902, 5: 903, 6: 904} and len(before) == 4 and len(folded) == 3
    assert store.gold().count() == 6
    assert store.compact() == [2024] and store.folded() == [(1, 4)]
    assert {r["price_date"].day: r["close_price"] for r in store.live().collect()} == rows


def test_a_load_logs_its_own_batches_only(spark, store, tmp_path):
    (tmp_path / "l").mkdir()
    sizes = []
    for number in range(4):
        for name in ("aapl", "msft"):
            (tmp_path / "l" / f"{name}.csv").write_text(HEAD + bars(1, 2))
        load(store, str(tmp_path / "l"), "MANUAL_CSV", now=T1, refresh=False)
        sizes.append(spark.read.parquet(store.path("batch_log")).count())
    assert sizes == [4, 8, 12, 16] and store.version("batch_meta") == 0
    batches = store.read("batch_meta").collect()
    assert sorted(r["batch_id"] for r in batches) == list(range(1, 9)) and {r["status"] for r in batches} == {"SUCCESS"}


def test_unreadable_and_unparsable_input_is_kept_apart(spark, store, tmp_path):
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "AAA.csv").write_text(HEAD + bars(1, 20) + "2024-02-01,1,9,0.5,,5,1\nlater,1,9,0.5,1,5,1\n")
    (tmp_path / "q" / "BBB.csv.gz").write_bytes(b"this is not gzip")
    (tmp_path / "q" / "CCC.csv").write_text(HEAD)
    out = results(bulk_load(store, str(tmp_path / "q"), pattern="*.csv*", now=T1))
    assert {k: v["outcome"] for k, v in out.items()} == {"AAA": "loaded", "BBB.CSV": "failed", "CCC": "failed"}
    assert {r["status"] for r in store.read("batch_meta").where("error_message is not null").collect()} == {"FAILED"}
    kept = store.read("quarantine").collect()
    assert sorted((r["row_number"] or 0, r["reason"]) for r in kept) == [
        (0, "java.io.IOException: not a gzip file"), (21, "prices missing or against the OHLC rule"), (22, "no ISO date")]
    report = {r["source_file"].rsplit("/", 1)[1]: r for r in validate_only(spark, str(tmp_path / "q"), "*.csv*").collect()}
    assert {n: (r["schema_valid"], r["quality_score"] > 0, r["schema_error"]) for n, r in report.items()} == {
        "AAA.csv": (True, True, None), "BBB.csv.gz": (False, False, "java.io.IOException: not a gzip file"), "CCC.csv": (False, False, "DataFrame is empty")}


def test_many_small_files_are_read_by_few_tasks(spark, store, tmp_path):
    (tmp_path / "many").mkdir()
    for n in range(300):
        (tmp_path / "many" / f"T{n:03d}.csv").write_text(HEAD + bars(1, 1))
    tasks = []
    from pricehouse.sources import csv_staging

    kept = csv_staging.materialize

    def materialize(df, label):
        out = kept(df, label)
        tasks.append((label, len(out.inputFiles())))
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(csv_staging, "materialize", materialize)
        staged = csv_staging.stage_csv(spark, str(tmp_path / "many"))
    assert dict(tasks)["lines"] <= 4 and spark.conf.get("spark.sql.files.openCostInBytes", None) != str(256 << 10)
    assert staged.count() == staged.select("source_file").distinct().count() == 300


def test_gold_history_equals_gold_after_each_load(spark):
    """Loads that replace each other's bars, of several sources and batches, some failed, one load from elsewhere."""
    import random

    from pricehouse import schemas as S
    from pricehouse.plans.gold import build_gold, current_prices, gold_history

    rng = random.Random(7)
    stamp = [datetime(2024, 2, d, tzinfo=timezone.utc) for d in range(1, 9)]
    batches = [(b, 1 + b % 3, rng.choice(stamp), rng.choice(["SUCCESS", "SUCCESS", "FAILED"]) if b < 20 else "SUCCESS") for b in range(40)]
    rows = []
    for i in range(900):
        load = rng.choice([2, 3, 9, *range(4, 8)])
        batch = rng.randrange(20) if load in (2, 3, 9) else 20 + (load - 4) * 5 + rng.randrange(5)
        day = date(rng.choice([2023, 2024]), 12, rng.randint(1, 4))
        rows.append((i, rng.randint(1, 12), batch, 1 + batch % 3, day, rng.choice(["DAILY"] * 9 + ["WEEKLY"]), float(i), load, rng.choice(stamp), i))
    raw = spark.createDataFrame(
        rows, "price_id BIGINT, asset_id INT, batch_id INT, source_id INT, price_date DATE, granularity STRING, close_price DOUBLE, "
        "load_seq BIGINT, created_at TIMESTAMP, row_number BIGINT")
    for c in ("open_price", "high_price", "low_price", "volume", "adj_close_price"):
        raw = raw.withColumn(c, F.lit(1.0))
    assets = spark.createDataFrame([(a, f"S{a}", "STOCK", "USD", "X", "N", a != 5) for a in range(1, 13)],
                                   "asset_id INT, symbol STRING, asset_type STRING, currency STRING, exchange STRING, company_name STRING, is_active BOOLEAN")
    sources = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "source_id INT, source_name STRING")
    meta = spark.createDataFrame(batches, "batch_id INT, source_id INT, start_time TIMESTAMP, status STRING")
    history = gold_history(raw, assets, sources, meta, 4, 7).persist()
    for n in range(4, 8):
        seen = raw.where(~F.col("load_seq").between(n + 1, 7))
        want = build_gold(current_prices(seen), assets, sources, meta)
        got = history.where((F.col("from_load") <= n) & (F.col("until_load").isNull() | (F.col("until_load") > n)))
        assert sorted(map(str, got.select(*S.GOLD_COLUMNS).collect())) == sorted(map(str, want.collect())) != []
    history.unpersist()


def test_refreshes_of_a_backlog_share_one_history(spark, store, tmp_path, monkeypatch):
    """Five groups over two years: the rows of all refreshes are written by one job, each version is whole."""
    from pricehouse.plans import store as store_module

    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "ibm.csv").write_text(HEAD + bars(1, 3, 50.0).replace("2024-", "2022-"))
    bulk_load(store, str(tmp_path / "old"), now=T1)
    names = ["p/aapl", "p/msft", "q/aapl", "q/ko", "r/msft"]
    for n, name in enumerate(names):
        file = tmp_path / "in" / f"{name}.csv"
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(HEAD + bars(1 + n, 3, 100.0 * (n + 1)) + (bars(1, 1, 7.0 + n).replace("2024-", "2023-") if n % 2 == 0 else ""))
        os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))
    written, seen = [], []
    publish_rows, refresh = store_module.publish, Store.refresh_gold

    def publishing(spark, path, *args, **named):
        written.append(path.rsplit("/", 1)[1])
        return publish_rows(spark, path, *args, **named)

    def refreshing(self, years=None, tries=5, pending=None, **named):
        if len(seen) == 2:  # another writer publishes in between: what it did is kept, the rest is worked out anew
            refresh(self, [2022])
        refresh(self, years, tries, pending, **named)
        gold = read_published(spark, self.path("price_gold"))
        want = self.gold(None, pending)
        assert sorted(map(str, gold.select(want.columns).collect())) == sorted(map(str, want.collect()))
        found = self.gold_of(["AAPL", "KO"]).select(want.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, want.where("symbol in ('AAPL', 'KO')").collect()))
        statuses = {r["status"] for r in self.read("batch_meta").where("batch_id > 1").collect()}
        seen.append((gold.count(), "RUNNING" in statuses))

    monkeypatch.setattr(store_module, "publish", publishing)
    monkeypatch.setattr(Store, "refresh_gold", refreshing)
    stream_load(store, str(tmp_path / "in" / "*"), str(tmp_path / "ckpt"), refresh_batch=1).awaitTermination()
    assert [s[1] for s in seen] == [True, True, True, True, False] and seen[-1][0] == 19
    # one by the other writer, two after it, one of the last group; none by the first two groups
    assert written.count("price_gold") == 4

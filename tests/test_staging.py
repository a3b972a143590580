import hypothesis.strategies as st
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from pricehouse.session import materialize
from pricehouse.sources.csv_staging import _all_lines, list_files, read_lines, stage_csv, stage_lines, standardize_columns, with_state


def write(folder, name, text):
    (folder / name).write_text(text)
    return str(folder / name)


def rows_of(df):
    return {
        (r["source_file"].rsplit("/", 1)[1], r["row_number"]): r.asDict()
        for r in df.collect()
    }


def test_files_with_differing_headers_are_aligned(spark, tmp_path):
    write(tmp_path, "AAPL.csv", "Date,Open,High,Low,Close,Volume,Adj Close\n2024-01-01,1,2,0.5,1.5,10,1.4\n")
    write(tmp_path, "m.csv", "ticker,price,low,high,open,trade_date,vol\nMSFT,11,9,12,10,2024-01-02,7\nMSFT,N/A,9,12,10,2024-01-03,\n")
    write(tmp_path, "x.csv", ' Close ,"Date"\n"1,5",2024-01-04\n5\n6,2024-01-05,extra\n')
    got = rows_of(stage_csv(spark, str(tmp_path)))
    assert len(got) == 6
    a = got["AAPL.csv", 1]
    assert (a["symbol"], a["date_str"], a["open_str"], a["close_str"], a["volume_str"], a["adj_close_str"]) == (
        "AAPL", "2024-01-01", "1", "1.5", "10", "1.4")
    m = got["m.csv", 1]
    assert (m["symbol"], m["close_str"], m["low_str"], m["high_str"], m["date_str"], m["adj_close_str"]) == (
        "MSFT", "11", "9", "12", "2024-01-02", None)
    assert got["m.csv", 2]["close_str"] is None and got["m.csv", 2]["volume_str"] is None
    x = got["x.csv", 1]
    assert (x["symbol"], x["close_str"], x["date_str"], x["open_str"]) == ("X", "1,5", "2024-01-04", None)
    assert got["x.csv", 2]["close_str"] == "5" and got["x.csv", 2]["date_str"] is None
    assert got["x.csv", 3]["date_str"] == "2024-01-05"


def test_empty_and_header_only_files_give_no_rows(spark, tmp_path):
    write(tmp_path, "E.csv", "")
    write(tmp_path, "H.csv", "Date,Close\n")
    assert stage_csv(spark, str(tmp_path)).count() == 0
    write(tmp_path, "R.csv", "Date,Close\n\n2024-01-01,3\n\n2024-01-02,4\n")
    got = rows_of(stage_csv(spark, str(tmp_path)))
    assert {k: v["close_str"] for k, v in got.items()} == {("R.csv", 1): "3", ("R.csv", 2): "4"}


def test_row_numbers_follow_file_order_when_files_are_split(spark, tmp_path):
    body = "".join(f"2024-01-01,{i}\n" for i in range(1, 4001))
    for name in ("A.csv", "B.csv"):
        write(tmp_path, name, "Date,Close\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        lines = materialize(read_lines(spark, [str(tmp_path)]), "lines")
        assert lines.select("source_file", "block").distinct().count() > 10
        staged = stage_lines(lines)
        assert staged.count() == 8000
        assert staged.where("cast(close_str as bigint) <> row_number").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_list_files_reads_names_and_sizes(spark, tmp_path):
    path = write(tmp_path, "btc-usd.csv", "Date\n1\n")
    write(tmp_path, "other.txt", "x")
    row = list_files(spark, str(tmp_path)).collect()
    assert len(row) == 1 and row[0]["symbol"] == "BTC-USD" and row[0]["file_size_bytes"] == 7
    assert row[0]["path"].endswith(path)


def test_standardize_columns_takes_first_alias(spark):
    df = spark.createDataFrame([("a", "b", "c", "/d/BTC-USD.csv")], "Time STRING, date STRING, ` PRICE ` STRING, source_file STRING")
    row = standardize_columns(df).first()
    assert (row["date_str"], row["close_str"], row["symbol"], row["open_str"]) == ("b", "c", "BTC", None)


def test_quoted_line_breaks_stay_in_their_field(spark, tmp_path):
    write(tmp_path, "Q.csv", 'Date,Close,"Vol\nume",Open\n2024-01-01,1,"two\n\nlines",7\n\n2024-01-02,2,x,"8"\n2024-01-03,3,"a ""quoted"" word\n",9\n')
    write(tmp_path, "P.csv", "Date,Close\n2024-01-01,4\n2024-01-02,5\n")
    got = rows_of(stage_csv(spark, str(tmp_path)))
    assert {k: (v["date_str"], v["close_str"], v["open_str"]) for k, v in got.items()} == {
        ("Q.csv", 1): ("2024-01-01", "1", "7"), ("Q.csv", 2): ("2024-01-02", "2", "8"), ("Q.csv", 3): ("2024-01-03", "3", "9"),
        ("P.csv", 1): ("2024-01-01", "4", None), ("P.csv", 2): ("2024-01-02", "5", None),
    }


def test_quoted_line_breaks_across_splits(spark, tmp_path):
    body = "".join(f'2024-01-01,{i},"note\n{"x" * (i % 90)}\n"\n' for i in range(1, 1501))
    write(tmp_path, "A.csv", "Date,Close,Note\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        staged = stage_csv(spark, str(tmp_path))
        assert staged.count() == 1500 and staged.where("cast(close_str as bigint) <> row_number").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_unreadable_exchange_list_counts_as_empty(spark, tmp_path):
    path = write(tmp_path, "n.txt", "Symbol\tName\nabc\tx\n")
    from pricehouse.sources.lists import read_exchange_lists

    got = read_exchange_lists(spark, {"NYSE": path, "AMEX": str(tmp_path / "absent")}).collect()
    assert [tuple(r) for r in got] == [("NYSE", "ABC")]


def test_quotes_open_a_field_at_its_start_only(spark, tmp_path):
    rows = [f"2024-01-{i:02d},{i},note" for i in range(1, 11)]
    rows[2] = '2024-01-03,3,5" x'
    write(tmp_path, "I.csv", "Date,Close,Note\n" + "\n".join(rows) + "\n")
    rows[4] = '2024-01-05,5,"open'
    write(tmp_path, "U.csv", "Date,Close,Note\n" + "\n".join(rows))
    write(tmp_path, "E.csv", 'Note,Close,Date\n"a ""b, c"" d",1,2024-01-01\n"x"" ",2,2024-01-02\n""" ""\n y",3,2024-01-03\n')
    got = rows_of(stage_csv(spark, str(tmp_path)))
    for name in ("I.csv", "U.csv"):
        assert [got[name, i]["date_str"] for i in range(1, 11)] == [f"2024-01-{i:02d}" for i in range(1, 11)]
    assert [got["E.csv", i]["close_str"] for i in (1, 2, 3)] == ["1", "2", "3"] and len(got) == 23


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.lists(st.sampled_from(['"', '""', "a", ",", "\n", " "]), max_size=14), min_size=1, max_size=12), split=st.sampled_from([25, 1000]))
def test_line_states_equal_a_walk_over_the_letters(spark, tmp_path_factory, texts, split):
    """Every file against a plain automaton, in one split and in many."""
    folder = tmp_path_factory.mktemp("walk")
    wanted = {}
    for i, parts in enumerate(texts):
        text = "Date,Close\n" + "".join(parts) + "\nend"
        write(folder, f"F{i}.csv", text)
        inside, start, begins = False, True, []
        for line in text.split("\n"):
            begins.append(not inside)
            start = True
            at = 0
            while at < len(line):
                c = line[at]
                if inside and c == '"' and line[at : at + 2] == '""':
                    at += 1
                elif inside and c == '"':
                    inside, start = False, False
                elif not inside and c == '"' and start:
                    inside = True
                elif not inside:
                    start = c == ","
                at += 1
        wanted[f"F{i}.csv"] = (begins, not inside)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        lines = materialize(_all_lines(spark, [str(folder)], "*.csv").withColumn("position", F.monotonically_increasing_id()), "all")
        got = {}
        for r in with_state(lines).orderBy("block", "position").collect():
            name = r["source_file"].rsplit("/", 1)[1]
            got.setdefault(name, ([], r["closed"]))[0].append(r["begins"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == wanted


def test_many_folders_are_listed_in_few_tasks(spark, tmp_path):
    for n in range(60):  # over 32, Spark lists them by a job
        (tmp_path / f"f={n}").mkdir()
        write(tmp_path, f"f={n}/A.csv", "Date,Close\n2024-01-01,1\n")
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    spark.sparkContext.setJobGroup("listing", "listing")
    assert list_files(spark, str(tmp_path)).count() == 60
    tracker = spark.sparkContext.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
    assert max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(name, None) in (None, "10000")


def test_unreadable_files_are_named_and_left_out(spark, tmp_path):
    write(tmp_path, "A.csv", "Date,Close\n2024-01-01,1\n")
    write(tmp_path, "empty.csv", "")
    names = ["part=1/B.csv.gz", *[f"B{i}.csv.gz" for i in range(5)]]
    (tmp_path / "part=1").mkdir()
    for name in names:
        (tmp_path / name).write_bytes(b"\x1f\x8bnot a gzip file")
        bad = []
        staged = stage_csv(spark, [str(tmp_path), str(tmp_path / "part=1")], "*.csv*", bad)
        assert staged.count() == 1 and {f for f, _ in bad} == {f"file:{tmp_path}/{n}" for n in names[: names.index(name) + 1]}
    assert all(message for _, message in bad)

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom import sources
from starloom.sources import Source, position
from starloom.sources.html import first_table


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def data(df):
    return [tuple(r) for r in df.orderBy(S.POSITION).drop(S.POSITION).collect()]


def test_csv_text_nulls_and_order(spark, tmp_path):
    path = write(tmp_path / "a.csv", ',Name,Level\n0,"A ""x"", y",N/A\n1,b,\n2,nan,L1\n')
    df = sources.read_csv(spark, path)
    assert df.columns == ["_c0", "Name", "Level", S.POSITION]
    assert data(df) == [("0", 'A "x", y', None), ("1", "b", None), ("2", None, "L1")]


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b\n"x\ny",1\n')
    assert data(sources.read_csv(spark, path, multi_line=True)) == [("x\ny", "1")]
    assert data(sources.read_csv(spark, path)) == [("x\ny", "1")]
    path = write(tmp_path / "b.csv", 'a,b\n1,"x\ny"\n2,z\n')  # a break in the last column
    assert data(sources.read_csv(spark, path)) == [("1", "x\ny"), ("2", "z")]


BROKEN_FIELDS = [
    "x", "", '"a,b"', '"say ""hi"""', '"two\nlines"', '"\n\n"', '"q""\n""q,\nend"', '5" pipe', 'a"b"c',
    '"""\n"""', '""', " pad ", '"late"tail', '"\na"tail', "N/A", '"' + "long\n" * 30 + '"']


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_records_over_many_splits_equal_the_whole_file(spark, tmp_path, end, monkeypatch):
    rng = random.Random(7)
    lines = ["id,left,right"]
    for i in range(1200):
        if rng.random() < 0.02:
            lines.append("")
        cells = [rng.choice(BROKEN_FIELDS if rng.random() < 0.3 else ["plain", "z"]) for _ in "ab"]
        lines.append(",".join([str(i), *cells]))
    path = tmp_path / "a.csv"
    path.write_text(end.join(lines) + end, encoding="utf-8", newline="")
    whole = data(sources.read_csv(spark, str(path), multi_line=True))
    monkeypatch.setattr(position, "BLOCK_BITS", 6)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = sources.read_csv(spark, str(path))
        found = data(df)
        splits = df.select(f"{S.POSITION}.block").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert splits > 10 and len(found) == 1200
    assert found == whole


@pytest.mark.parametrize("text", [
    'a,b\n1,"x\ny"\n2,"open\n3,z', 'a,"b\nc"\n1,"x\ny"\n', 'a,b\r1,"x\ry"\r2,z\r'])
def test_csv_quotes_that_stay_open_or_span_the_header(spark, tmp_path, text):
    path = tmp_path / "a.csv"
    path.write_text(text, encoding="utf-8", newline="")
    assert data(sources.read_csv(spark, str(path), damaged=True)) == data(
        sources.read_csv(spark, str(path), multi_line=True, damaged=True))


def test_csv_broken_records_with_line_breaks(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b\n"x\ny",1,EXTRA\n2,U2\n')
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        sources.read_csv(spark, path).collect()
    found = [(r["a"], r["_damaged"]) for r in sources.read_csv(spark, path, damaged=True).orderBy("a").collect()]
    assert found == [("2", None), ("x\ny", '"x\ny",1,EXTRA')]


def test_csv_folder_with_two_column_orders(spark, tmp_path):
    for name, text in (("a", "order_id,user_id\nO1,U1\n"), ("b", "user_id,order_id,more\nU2,O2,x\n"),
                       ("c", 'order_id,user_id\nO3,"U\n3"\n')):
        write(tmp_path / f"{name}.csv", text)
    df = sources.read_csv(spark, str(tmp_path)).select("order_id", "user_id", "more")
    assert sorted(map(tuple, df.collect())) == [
        ("O1", "U1", None), ("O2", "U2", "x"), ("O3", "U\n3", None)]


@pytest.mark.parametrize("row", ["1,U1,EXTRA", "1"])
def test_csv_records_of_other_length(spark, tmp_path, row):
    path = write(tmp_path / "a.csv", f"a,b\n{row}\n2,U2\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        sources.read_csv(spark, path).collect()
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        sources.read_csv(spark, path).select("a").collect()
    df = sources.read_csv(spark, path, damaged=True)
    assert [(r["a"], r["_damaged"]) for r in df.orderBy("a").collect()] == [("1", row), ("2", None)]


def test_damaged_json(spark, tmp_path):
    whole = json.dumps([{"id": 1, "n": "x"}, {"id": 2, "n": "y"}])
    cut = write(tmp_path / "cut.json", whole[:-9])
    lines = write(tmp_path / "lines.json", '{"id": 1, "n": "x"}\n{"id": 2, "n"\n')
    for path, multi in ((cut, True), (lines, False)):
        with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
            sources.read_json_records(spark, path, ["id", "n"], multi_line=multi).collect()
    df = sources.read_json_records(spark, lines, ["id", "n"], damaged=True)
    assert {(r["id"], r["_damaged"]) for r in df.collect()} == {("1", None), (None, '{"id": 2, "n"')}
    columnar = write(tmp_path / "columnar.json", '{"id": {"0": 1, "1"')
    with pytest.raises(Exception, match="no columnar JSON document"):
        sources.read_json_columnar(spark, columnar, ["id"]).collect()


def test_fallback_when_a_file_is_refused(spark, tmp_path):
    path = write(tmp_path / "a.parquet", "a,b\n1,2\n")
    assert data(sources.read_source(spark, Source(path, fallback="csv"))) == [("1", "2")]
    with pytest.raises(Exception):
        sources.read_source(spark, Source(path)).collect()


@pytest.mark.parametrize("part", ['<td "', "<!--", "<td colspan='", "<tr><td>", "<table>", "<script>", "<"])
def test_hostile_pages_take_linear_time(part):
    start = time.perf_counter()
    first_table("<table><tr><td>1</td></tr>" + part * (1_000_000 // len(part)))
    assert time.perf_counter() - start < 15


def test_spans_are_bounded():
    header, body = first_table('<table><tr><td colspan="999999999" rowspan=0>x</td></tr></table>')
    assert len(header) == 1000 and len(body) == 1


def test_text_positions_follow_files_and_lines(spark, tmp_path):
    for name, start in (("b", 100), ("a", 0)):
        lines = "\n".join(str(start + i) for i in range(50))
        write(tmp_path / f"{name}.csv", f"v\n{lines}\n")
    got = [int(v) for v, in data(sources.read_csv(spark, str(tmp_path)))]
    assert got == [*range(50), *range(100, 150)]


def test_parquet_positions(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(100).coalesce(1).sortWithinPartitions(F.desc("id")).write.parquet(path)
    assert [v for v, in data(sources.read_parquet(spark, path))] == list(range(99, -1, -1))


def test_json_records_array(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps([{"id": 1, "n": "x"}, {"id": 2.5, "n": "null"}]))
    assert data(sources.read_json_records(
        spark, path, ["id", "n"], multi_line=True)) == [("1", "x"), ("2.5", None)]


def test_json_columnar_aligns_outer(spark, tmp_path):
    doc = {" User_ID ": {"0": "u0", "1": "u1", "10": "u10"}, "name": {"0": "a", "10": None, "12": "z"}}
    path = write(tmp_path / "a.json", json.dumps(doc))
    got = data(sources.read_json_columnar(spark, path, ["user_id", "name"]))
    assert got == [("u0", "a"), ("u1", None), ("u10", None), (None, "z")]


def test_tab_packed(spark, tmp_path):
    path = write(tmp_path / "c.csv", (
        "\tcampaign_id\tcampaign_name\tcampaign_description\tdiscount\n"
        '0\tC1\tbig, bold\t"""Quoted words."" - Some One"\t10%%\n1\tC2\tplain\tno quotes\t1pct\n'))
    columns = S.STAGING["stg_campaign_data"].fieldNames()
    got = data(sources.read_tab_packed(spark, path, columns))
    assert got == [("C1", "big, bold", '"""Quoted words."" - Some One"', "10%%"),
                   ("C2", "plain", "no quotes", "1pct")]


@pytest.mark.parametrize("page, expected", [
    ("<p>nothing</p>", None),
    ("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>x &amp; y</td></tr></table>"
     "<table><tr><td>no</td></tr></table>", (["a", "b"], [["1", "x & y"]])),
    # open tags, a row header, white space and markup inside cells
    ("<TABLE><thead><tr><th><th>v<tbody><tr><th>0<td> 5 <b>days</b>\n<tr><th>1<td>6</table>",
     (["", "v"], [["0", "5 days"], ["1", "6"]])),
    # spans, a nested table, a short row
    ("<table><tr><th>a</th><th>b</th></tr><tr><td rowspan=2>r</td><td>1</td></tr>"
     "<tr><td>2<table><tr><td>in</td></tr></table></td></tr><tr><td colspan='2'>w</td></tr>"
     "<tr><td>s</td></tr></table>",
     (["a", "b"], [["r", "1"], ["r", "2 in"], ["w", "w"], ["s", None]])),
    ("<table><tr><td>1</td><td>2</td></tr></table>", (["0", "1"], [["1", "2"]])),
    # comments, scripts, a tag end inside an attribute, a cut-off page
    ("<!-- <table><tr><td>no</td></tr></table> --><script>'<table>'</script><table><tr>"
     "<th title='x > y'>a<tr><td>1<br>2&nbsp;3<tr><td>4 < 5", (["a"], [["1 2 3"], ["4 < 5"]])),
])
def test_first_table(page, expected):
    assert first_table(page) == expected


def test_html_reader(spark, tmp_path):
    rows = "".join(f"<tr><td>{i}</td><td>O{i}</td><td>{'N/A' if i == 1 else i}</td></tr>" for i in range(3))
    head = "<tr><th></th><th>Order_ID</th><th>Delay in days</th></tr>"
    path = write(tmp_path / "d.html", f"<table>{head}{rows}</table>")
    got = data(sources.read_html(spark, path, ["order_id", "delay_in_days"]))
    assert got == [("O0", "0"), ("O1", None), ("O2", "2")]
    empty = write(tmp_path / "e.html", "<p>no table here</p>")
    with pytest.raises(Exception, match="no table"):
        sources.read_html(spark, empty, ["a"]).collect()


def test_format_by_extension_and_fallback(spark, tmp_path):
    path = write(tmp_path / "list.xlsx", "a,b\n1,2\n")
    with pytest.raises(ValueError, match="xlsx"):
        sources.read_source(spark, sources.Source(path))
    assert data(sources.read_source(spark, sources.Source(path, fallback="csv"))) == [("1", "2")]


def test_missing_table_is_empty_but_broken_is_not(spark):
    schema = S.STAGING["stg_order_delays"]
    assert sources.table_or_empty(spark, "starloom_not_there", schema).count() == 0
    spark.range(3).createOrReplaceTempView("starloom_there")
    assert sources.table_or_empty(spark, "starloom_there", schema).count() == 3

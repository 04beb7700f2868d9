"""Readers: the tables are written out in a source format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom import functions as fn
from starloom import schemas as S
from starloom import sources
from starloom.operators import headers
from starloom.plans import staging
from starloom.queries import standin as st
from starloom.queries.registry import query
from starloom.session import scratch_path

_PAGE_ROWS = 200
_DOC_ROWS = 500


@query("scan_parquet", """
SELECT file_row - 1 AS line_row, l_orderkey, l_partkey, l_extendedprice FROM file_lines
""")
def scan_parquet(spark, sf_dir):
    """Parquet scan with the row index of the file; four of eleven columns are read."""
    return sources.read_parquet(spark, f"{sf_dir}/lineitem.parquet").select(
        F.col(f"{S.POSITION}.row").alias("line_row"), "l_orderkey", "l_partkey", "l_extendedprice")


@query("scan_csv", """
SELECT c_custkey::VARCHAR AS user_id, c_name || ', "' || c_mktsegment || '"' AS name,
       CASE WHEN c_custkey % 5 > 1 THEN 'L' || (c_custkey % 5) END AS job_level
FROM customer
""")
def scan_csv(spark, sf_dir):
    """CSV with header, quoted commas, doubled quotes and null spellings."""
    k = F.col("c_custkey")
    path = scratch_path(spark, "csv")
    st.table(spark, sf_dir, "customer").select(
        k.alias("user_id"),
        F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("name"),
        F.when(k % 5 == 0, "N/A").when(k % 5 == 1, "null")
        .otherwise(F.concat(F.lit("L"), st.text(k % 5))).alias("job_level"),
    ).write.csv(path, header=True, escape='"')
    return sources.read_csv(spark, path).drop(S.POSITION)


@query("scan_csv_mixed_headers", """
SELECT c_custkey::VARCHAR AS user_id, c_name AS name,
       CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS segment,
       CASE WHEN c_custkey % 3 = 0 THEN 'line one' || chr(10) || c_custkey ELSE 'plain' END AS note
FROM customer
""")
def scan_csv_mixed_headers(spark, sf_dir):
    """A folder whose files order their columns differently; notes hold quoted line breaks."""
    k = F.col("c_custkey")
    path = scratch_path(spark, "csv-mixed")
    note = F.when(k % 3 == 0, F.concat(F.lit("line one\n"), st.text(k))).otherwise("plain")
    base = st.table(spark, sf_dir, "customer").select(
        st.text(k).alias("user_id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), note.alias("note"))
    key = F.col("user_id").cast("long")
    base.filter(key % 2 == 0).select("user_id", "name", "note").write.csv(
        path, header=True, escape='"')
    base.filter(key % 2 == 1).select("note", "segment", "name", "user_id").write.mode("append").csv(
        path, header=True, escape='"')
    return sources.read_csv(spark, path).drop(S.POSITION)


@query("scan_csv_quoted_breaks", """
SELECT o_orderkey::VARCHAR AS order_id,
       CASE o_orderkey % 4 WHEN 0 THEN 'first "one"' || chr(10) || 'last, ' || o_orderkey
                           WHEN 1 THEN '6" pipe' WHEN 2 THEN 'plain' END AS note,
       o_orderstatus AS status
FROM orders
""")
def scan_csv_quoted_breaks(spark, sf_dir):
    """Records over two lines, doubled quotes and quotes inside plain fields, split among tasks."""
    k = F.col("o_orderkey")
    path = scratch_path(spark, "csv-breaks")
    note = F.when(k % 4 == 0, F.concat(F.lit('"first ""one""\nlast, '), st.text(k), F.lit('"'))).when(
        k % 4 == 1, '6" pipe').when(k % 4 == 2, "plain").otherwise("")
    record = F.concat_ws(",", st.text(k), note, "o_orderstatus")
    st.table(spark, sf_dir, "orders").select(
        F.explode(F.split(record, "\n")).alias("order_id,note,status")).write.csv(
        path, header=True, sep="\t", quote="")
    return sources.read_csv(spark, path).drop(S.POSITION)


@query("scan_csv_ragged", """
SELECT c_custkey::VARCHAR AS user_id,
       CASE WHEN c_custkey % 5 = 0 THEN c_custkey || ',' || c_name || ',EXTRA'
            WHEN c_custkey % 7 = 0 THEN c_custkey::VARCHAR END AS damaged_record,
       CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN c_name END AS name
FROM customer
""")
def scan_csv_ragged(spark, sf_dir):
    """Records with a field too many or too few come with their text; the others are whole."""
    k = F.col("c_custkey")
    path = scratch_path(spark, "csv-ragged")
    line = F.when(k % 5 == 0, F.concat_ws(",", st.text(k), "c_name", F.lit("EXTRA"))).when(
        k % 7 == 0, st.text(k)).otherwise(F.concat_ws(",", st.text(k), "c_name"))
    st.table(spark, sf_dir, "customer").select(line.alias("user_id,name")).write.csv(
        path, header=True, sep="\t", quote="")
    found = sources.read_csv(spark, path, damaged=True)
    damaged = F.col(sources.DAMAGED)
    return found.select(
        "user_id", damaged.alias("damaged_record"),
        F.when(damaged.isNull(), F.col("name")).alias("name"))


@query("scan_json_damaged", """
SELECT CASE WHEN s_suppkey % 6 <> 0 THEN s_suppkey::VARCHAR END AS merchant_id,
       CASE WHEN s_suppkey % 6 <> 0 THEN s_name END AS name,
       CASE WHEN s_suppkey % 6 = 0 THEN '{"merchant_id": ' || s_suppkey || ', "name": "' END
           AS damaged_record
FROM supplier
""")
def scan_json_damaged(spark, sf_dir):
    """One record per line; cut records come with their text and lose nothing else."""
    k = F.col("s_suppkey")
    path = scratch_path(spark, "json-damaged")
    head = F.concat(F.lit('{"merchant_id": '), st.text(k), F.lit(', "name": "'))
    st.table(spark, sf_dir, "supplier").select(
        F.when(k % 6 == 0, head).otherwise(F.concat(head, "s_name", F.lit('"}'))).alias("value")
    ).write.text(path)
    found = sources.read_json_records(spark, path, ["merchant_id", "name"], damaged=True)
    return found.select("merchant_id", "name", F.col(sources.DAMAGED).alias("damaged_record"))


@query("read_with_fallback", """
SELECT s_suppkey::VARCHAR AS merchant_id, s_name AS name FROM supplier
""")
def read_with_fallback(spark, sf_dir):
    """A source that is called Parquet and holds comma-separated text."""
    path = scratch_path(spark, "misnamed")
    st.table(spark, sf_dir, "supplier").select(
        st.text("s_suppkey").alias("merchant_id"), F.col("s_name").alias("name")
    ).write.csv(path, header=True)
    return sources.read_source(
        spark, sources.Source(path, "parquet", fallback="csv")).drop(S.POSITION)


@query("scan_tab_packed", """
SELECT p_partkey::VARCHAR AS campaign_id, p_name AS campaign_name,
       p_type || ' - ' || p_brand AS campaign_description,
       (p_partkey % 30)::DOUBLE AS discount
FROM part
""")
def scan_tab_packed(spark, sf_dir):
    """Tab-separated text inside a CSV, index column first, discounts like 10%%."""
    k = F.col("p_partkey")
    unit = F.when(k % 3 == 0, "%").when(k % 3 == 1, "pct").otherwise("%%")
    lines = st.table(spark, sf_dir, "part").select(F.concat_ws(
        "\t", st.text(k - 1), st.text(k), "p_name",
        F.concat(F.lit('"""'), "p_type", F.lit('"" - '), "p_brand", F.lit('"')),
        F.concat(st.text(k % 30), unit)).alias("value"))
    columns = S.STAGING["stg_campaign_data"].fieldNames()
    path = scratch_path(spark, "packed")
    spark.createDataFrame([("\t" + "\t".join(columns),)], "value string").write.text(path)
    lines.write.mode("append").text(path)
    rows = staging.stage_campaigns(sources.read_tab_packed(spark, path, columns))
    return st.money_as_double(rows, "discount")


@query("scan_json_records", """
SELECT s_suppkey::VARCHAR AS merchant_id, s_name AS name, s_acctbal::VARCHAR AS balance
FROM supplier
""")
def scan_json_records(spark, sf_dir):
    """JSON records, one per line, declared columns as text."""
    path = scratch_path(spark, "json")
    st.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("merchant_id"), F.col("s_name").alias("name"),
        st.text("s_acctbal").alias("balance")).write.json(path)
    return sources.read_json_records(
        spark, path, ["merchant_id", "name", "balance"], multi_line=False).drop(S.POSITION)


@query("scan_json_columnar", """
SELECT c_custkey::VARCHAR AS user_id, c_name AS name,
       CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS user_type
FROM customer
""")
def scan_json_columnar(spark, sf_dir):
    """Documents {column: {row: value}} of 500 customers each; some columns miss rows."""
    k = F.col("c_custkey")
    row = st.text(k % _DOC_ROWS)

    def column(value, present=F.lit(True)):
        cell = F.when(present, F.struct(row.alias("key"), value.alias("value")))
        return F.map_from_entries(F.collect_list(cell))

    docs = st.table(spark, sf_dir, "customer").groupBy(
        F.floor(k / _DOC_ROWS).alias("doc")).agg(
        F.to_json(F.struct(
            column(st.text(k)).alias("User_id"), column(F.col("c_name")).alias("Name"),
            column(F.col("c_mktsegment"), k % 3 != 0).alias("user_type"))).alias("body"))
    rows = sources.columnar_json_rows(docs, "body", "doc", ["user_id", "name", "user_type"])
    return rows.drop(S.POSITION)


@query("extract_html_tables", """
SELECT o_orderkey::VARCHAR AS order_id, o_orderpriority || ' & <' || o_orderstatus || '>' AS note,
       (o_orderkey % 90)::INTEGER AS delay_in_days
FROM orders
""")
def extract_html_tables(spark, sf_dir):
    """First table of each page; the web pages of the data set take part and have no table."""
    k = F.col("o_orderkey")
    row = F.concat(
        F.lit("<tr><th>"), st.text(k % _PAGE_ROWS), F.lit("</th><td> "), st.text(k),
        F.lit("</td><td>"), "o_orderpriority", F.lit(" &amp; &lt;"), "o_orderstatus",
        F.lit("&gt;<td>"), st.text(k % 90), F.lit("</tr>"))
    head = ("<html><body><p>Report</p><table border=1><thead><tr><th></th><th>Order_ID</th>"
            "<th>Note</th><th>Delay in Days</th></tr></thead><tbody>")
    tail = "</tbody></table><table><tr><td>second</td></tr></table></body></html>"
    reports = st.table(spark, sf_dir, "orders").groupBy(
        F.floor(k / _PAGE_ROWS).alias("page_id")).agg(
        F.concat(F.lit(head), F.array_join(F.collect_list(row), "\n"), F.lit(tail)).alias("html"))
    pages = st.table(spark, sf_dir, "pages").select("page_id", "html").unionByName(reports)
    found = sources.extract_first_table(pages, "html", ["page_id"])
    cells = sources.html_columns(["order_id", "note", "delay_in_days"])
    return found.select(
        cells["order_id"].alias("order_id"), cells["note"].alias("note"),
        fn.digits_to_int(cells["delay_in_days"]).alias("delay_in_days"))


@query("scan_table_or_empty", """
SELECT s_suppkey, s_name FROM supplier
UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE false
""")
def scan_table_or_empty(spark, sf_dir):
    """A registered table, together with one that does not exist and counts as empty."""
    supplier = st.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    supplier.createOrReplaceTempView("starloom_supplier")
    there = sources.table_or_empty(spark, "starloom_supplier", supplier.schema)
    missing = sources.table_or_empty(spark, "starloom_never_loaded", supplier.schema)
    return there.unionByName(missing)


_SLICE_DAYS = ("1996-07-01", "1997-10-01", "1998-01-01", "1998-12-01", "1999-06-01")


@query("union_order_slices", """
SELECT order_id, user_id, estimated_arrival, transaction_date FROM stg_orders
""")
def union_order_slices(spark, sf_dir):
    """Six order slices with different headers that overlap by a month, united without doubles."""
    # slices are cut on the column itself, so their bounds reach the scan
    orders = st.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    odd = [lambda c: c.upper(), lambda c: f" {c}", lambda c: c.lower(),
           lambda c: c.title(), lambda c: f"{c} ", lambda c: c.replace("_", " ")]
    bounds = [None, *_SLICE_DAYS, None]
    slices = []
    for i, rename in enumerate(odd):
        part = orders
        if bounds[i]:
            begin = F.add_months(F.lit(bounds[i]).cast("date"), -1).cast("timestamp_ntz")
            part = part.filter(day >= begin)
        if bounds[i + 1]:
            part = part.filter(day < F.lit(bounds[i + 1]).cast("date").cast("timestamp_ntz"))
        part = st.as_raw_orders(part)
        part = part.withColumn(S.POSITION, F.col(S.POSITION).withField("slice", F.lit(i)))
        slices.append(part.toDF(*[rename(c) if c != S.POSITION else c for c in part.columns]))
    return staging.stage_orders(slices)


@query("union_by_name_text", """
SELECT o_orderkey::VARCHAR AS order_id,
       CASE WHEN o_orderkey % 3 <> 2 THEN o_custkey::VARCHAR END AS merchant_id,
       CASE WHEN o_orderkey % 3 <> 1 THEN o_orderstatus END AS staff_id,
       CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS channel_2
FROM orders
""")
def union_by_name_text(spark, sf_dir):
    """Three link slices with different columns: every column is kept, all as text."""
    o = st.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    first = o.filter(k % 3 == 0).select(
        k.alias("Order ID"), F.col("o_custkey").alias("Merchant-ID"),
        F.col("o_orderstatus").alias("staff id"), F.lit(1).alias("Unnamed: 0"))
    second = o.filter(k % 3 == 1).select(
        k.alias("order_id"), F.col("o_custkey").cast("int").alias("merchant_id"))
    third = o.filter(k % 3 == 2).select(
        k.alias("order_id"), F.col("o_orderstatus").alias("staff_id"),
        F.col("o_orderpriority").alias("Channel 2"))
    return headers.union_by_name_text([
        headers.sanitise_identifiers(headers.drop_junk_columns(s)) for s in (first, second, third)])

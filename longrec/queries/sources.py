"""Sources and sinks: driver tables written to the shared folder and read back."""

from pyspark.sql import functions as F

from longrec.functions import labels
from longrec.queries import query, table
from longrec.session import shared_dir
from longrec.sources import folders, reports, sinks, tables
from longrec.streaming import upsert


@query("csv_round_trip", "select c_custkey, c_name, c_nationkey::bigint c_nationkey, c_acctbal, c_mktsegment from customer")
def csv_round_trip(spark, d):
    """Written with the key in front, read with types found in one pass."""
    path = shared_dir(spark, "csv")
    sinks.write_csv(table(spark, d, "customer"), path, keys=["c_custkey"])
    return tables.read_table(spark, path)


@query("csv_schema_scan", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def csv_schema_scan(spark, d):
    path = shared_dir(spark, "csv")
    sinks.write_csv(table(spark, d, "supplier"), path)
    return tables.read_table(spark, path, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")


@query(
    "csv_text_scan",
    "select cast(event_id as varchar) event_id, case when event_type = 'error' then null else event_type end kind, "
    "case when event_type = 'signup' then null else cast(value as varchar) end as value from events",
)
def csv_text_scan(spark, d):
    """All text; the usual tokens for missing values become null."""
    kind = F.col("event_type")
    rows = table(spark, d, "events").select(
        "event_id", F.when(kind == "error", "N/A").otherwise(kind).alias("kind"),
        F.when(kind == "signup", "NaN").otherwise(F.col("value").cast("string")).alias("value"),
    )
    path = shared_dir(spark, "csv")
    sinks.write_csv(rows, path)
    df = tables.read_text_table(spark, path)
    assert tables.leading_keys(df, 1) == ["event_id"]
    return df


@query(
    "semicolon_report",
    """select 'nation' || n_nationkey || '_s1' as "Patient ID", 'nation' || n_nationkey as "Subject",
  'job' || lpad(cast(n_nationkey as varchar), 6, '0') job_id, case when n_regionkey < 2 then n_name end as region_name,
  cast(n_regionkey as varchar) "Age", 'F' "Sex" from nation""",
)
def semicolon_report(spark, d):
    """One report per nation; patient and job come from the path.  Regions get different headers."""
    patient = F.concat(F.lit("nation"), F.col("n_nationkey").cast("string"), F.lit("_s1-job"), F.lpad(F.col("n_nationkey").cast("string"), 6, "0"))
    path = shared_dir(spark, "reports")
    rows = table(spark, d, "nation").select(
        patient.alias("report"), F.col("n_name").alias("region_name"), F.col("n_regionkey").alias("Age"), F.lit("F").alias("Sex")
    )
    first = F.col("Age") < 2
    rows.where(first).write.partitionBy("report").csv(f"{path}/a", header=True, sep=";")
    rows.where(~first).drop("region_name").write.partitionBy("report").csv(f"{path}/b", header=True, sep=";")
    return reports.read_reports(spark, path, patient_pattern=r"nation\d+_s\d", glob="part*.csv")[0].drop(*folders.FILE_ORDER)


def _folder(spark, d):
    """CSV files with three different headers, one of them without the required column."""
    path = shared_dir(spark, "folder")
    rows = table(spark, d, "part")
    rows.where("p_size <= 20").select("p_partkey", "p_name", "p_size").write.csv(f"{path}/a", header=True)
    rows.where("p_size > 20 and p_size <= 40").select("p_brand", "p_partkey", "p_retailprice").write.csv(f"{path}/b", header=True)
    rows.where("p_size > 40").select("p_name", "p_type").write.csv(f"{path}/c", header=True)
    return path


@query(
    "folder_scan",
    """select p_partkey, case when p_size <= 20 then p_name end p_name, case when p_size <= 20 then p_size::bigint end p_size,
  case when p_size > 20 then p_brand end p_brand, case when p_size > 20 then p_retailprice end p_retailprice from part where p_size <= 40""",
)
def folder_scan(spark, d):
    """Files of differing headers united by name."""
    return folders.scan_folder(spark, _folder(spark, d), "p_partkey")[0].drop(*folders.FILE_ORDER)


@query("folder_scan_skipped", "select distinct 'no column named p_partkey' reason, 'c' as folder from part where p_size > 40")
def folder_scan_skipped(spark, d):
    """Files without the required column are reported."""
    skipped = folders.scan_folder(spark, _folder(spark, d), "p_partkey")[1]
    return skipped.select("reason", F.regexp_extract("file", r"/([abc])/[^/]*$", 1).alias("folder")).distinct()


@query(
    "file_names",
    """select url as path, 'Cust' || page_id as subject, 'visit_' || regexp_extract(url, '/([a-z]{2})/', 1) as visit
  from pages where url like 'https%' and regexp_extract(url, '/([a-z]{2})/', 1) <> ''""",
)
def file_names(spark, d):
    """Subject and visit from file names; names of another form are left out."""
    number = F.col("page_id").cast("string")
    language = F.regexp_extract("url", "/([a-z]{2})/", 1)
    good = F.concat(F.lit("Cust"), number, F.lit("_visit_"), language, F.lit(".pdf"))
    named = F.col("url").startswith("https") & (language != "")
    name = F.when(named, good).otherwise(F.concat(F.lit("scan"), number, F.lit(".pdf")))
    files = table(spark, d, "pages").select(F.col("url").alias("path"), name.alias("file"))
    return folders.parse_file_names(files, "cust").drop("file")


@query(
    "report_types",
    """with f as (select l_partkey, max(l_returnflag = 'R') method, max(l_linestatus = 'F') contrast from lineitem group by 1)
select p_partkey job_id, case when p_name like '%ring%' then 'rings' when p_name like '%bolt%' then 'bolts'
  else 'other_' || case when coalesce(method, false) then 'returned' else 'kept' end || '_' || case when coalesce(contrast, false) then 'filled' else 'open' end
  end as type from part left join f on l_partkey = p_partkey""",
)
def report_types(spark, d):
    """By text in the header, else by the files that came along."""
    headers = table(spark, d, "part").select(F.col("p_partkey").alias("job_id"), F.col("p_name").alias("header"))
    files = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("job_id"), F.concat_ws(".", "l_returnflag", "l_linestatus").alias("file")
    )
    return reports.classify_reports(
        headers, files, rules=[("ring", "rings"), ("bolt", "bolts")], stem="other",
        method=("R.%", "returned", "kept"), contrast=("%.F", "filled", "open"),
    )


_SPLIT = "2024-01-16"


def _batches(spark, d):
    events = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    old = events.where(F.col("ts") < F.lit(_SPLIT)).drop("value").withColumn("note", F.lit("old"))
    return old, events.where(F.col("ts") >= F.lit(_SPLIT))


@query(
    "upsert_reports",
    f"""with u as (select event_id, ts, user_id, event_type, null as value, 'old' note, 0 batch from events where ts < timestamp '{_SPLIT}'
  union all select event_id, ts, user_id, event_type, value, null, 1 from events where ts >= timestamp '{_SPLIT}')
select event_id, ts, user_id, event_type, value, note from (
  select *, row_number() over (partition by user_id, event_type order by batch desc, ts desc, event_id desc) rn from u) where rn = 1""",
)
def upsert_reports(spark, d):
    """Two batches with differing columns; the later one wins."""
    old, new = _batches(spark, d)
    return reports.upsert_reports(old, new, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "upsert_redo",
    f"""select event_id, ts, user_id, event_type, value from (
  select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) rn from events where ts >= timestamp '{_SPLIT}') where rn = 1""",
)
def upsert_redo(spark, d):
    """Doing it again ignores the old rows."""
    old, new = _batches(spark, d)
    return reports.upsert_reports(old, new, ["user_id", "event_type"], ["ts", "event_id"], redo=True)


@query(
    "unprocessed_jobs",
    "select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)",
)
def unprocessed_jobs(spark, d):
    jobs = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    done = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return reports.unprocessed(jobs, done, "o_orderkey")


_LATEST = """select o_custkey, o_orderstatus, o_orderkey, o_totalprice from (
  select *, row_number() over (partition by o_custkey, o_orderstatus order by o_orderdate >= date '1998-01-01' desc, o_orderdate desc, o_orderkey desc) rn
  from orders) where rn = 1"""


_STORE_KEYS, _STORE_ORDER = ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"]


def _halves(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice", "o_orderdate")
    early = F.col("o_orderdate") < F.lit("1998-01-01")
    return rows.where(early), rows.where(~early)


@query("upsert_store", _LATEST)
def upsert_store(spark, d):
    """Two batches into the store, the second one twice and once more after a compaction."""
    store = shared_dir(spark, "store")
    first, second = _halves(spark, d)
    options = (_STORE_KEYS, _STORE_ORDER, "o_orderstatus")
    upsert.upsert_batch(first, store, 0, *options)
    upsert.upsert_batch(second, store, 1, *options)
    upsert.upsert_batch(second, store, 1, *options)
    upsert.compact(spark, store, 1, *options[:2])
    upsert.upsert_batch(second, store, 2, *options)
    return upsert.read_store(spark, store, *options[:2]).select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")


@query("stream_upserts", _LATEST)
def stream_upserts(spark, d):
    """The same from a stream of files that is stopped and started again."""
    base = shared_dir(spark, "stream")
    for rows in _halves(spark, d):
        rows.write.mode("append").parquet(f"{base}/in")
        new = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        upsert.stream_upserts(
            new, f"{base}/store", f"{base}/checkpoint", _STORE_KEYS, _STORE_ORDER, "o_orderstatus"
        ).awaitTermination()
    return upsert.read_store(spark, f"{base}/store", _STORE_KEYS, _STORE_ORDER).select(
        "o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice"
    )


@query(
    "store_writers",
    """select o_custkey, o_orderstatus, o_orderkey, o_totalprice from (
  select *, row_number() over (partition by o_custkey, o_orderstatus order by o_orderkey % 4 desc, o_orderdate desc, o_orderkey desc) rn from orders) where rn = 1""",
)
def store_writers(spark, d):
    """Two writers and two streams with checkpoints of their own, each of which begins at batch 0; compacted and cleaned up in between."""
    base = shared_dir(spark, "store")
    store, options = f"{base}/store", (_STORE_KEYS, _STORE_ORDER)
    rows = table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice", "o_orderdate")
    quarters = [rows.where(F.col("o_orderkey") % 4 == k) for k in range(4)]
    upsert.upsert_batch(quarters[0], store, 0, *options, "o_orderstatus")
    for _ in range(2):
        upsert.upsert_batch(quarters[1], store, 0, *options, "o_orderstatus", writer="second")
    upsert.compact(spark, store, None, *options)
    for k in (2, 3):
        quarters[k].write.parquet(f"{base}/in{k}")
        new = spark.readStream.schema(rows.schema).parquet(f"{base}/in{k}")
        upsert.stream_upserts(new, store, f"{base}/checkpoint{k}", *options, "o_orderstatus").awaitTermination()
        upsert.compact(spark, store, None, *options)
        upsert.vacuum(spark, store, older_than_hours=-1)
    return upsert.read_store(spark, store, *options).select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")


@query(
    "labelled_cells",
    """with w as (select conv_id, role, turn, list_filter(string_split(text, ' '), lambda x: x <> '') words from conversations),
o as (select *, coalesce(sum(len(words)) over (partition by conv_id, role order by turn rows between unbounded preceding and 1 preceding), 0) start from w),
e as (select conv_id, role as label, start, unnest(words) cell, generate_subscripts(words, 1) place from o)
select conv_id, label, cast(count(*) over (partition by conv_id, label) as integer) width, cast(start + place - 1 as integer) as position, cell from e""",
)
def labelled_cells(spark, d):
    """The words of each role of a conversation, numbered over its turns."""
    lines = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    cells = F.concat(F.array("role"), F.split("text", " "))
    return reports.labelled_cells(lines, ["conv_id"], ["turn"], cells, ["user", "assistant", "system"])


@query(
    "json_documents",
    """select c_custkey || '_' || c_nationkey as id, '{"PersonInformation":{"IdentificationCode":"' || c_custkey || '_' || c_nationkey
  || '"},"Forms":[{"FormInstrument":{"Id":"form","Answers":[{"QuestionId":1,"Value":"' || cast(trunc(c_acctbal) as bigint) || '","Comments":[]}'
  || case when c_mktsegment = 'BUILDING' then '' else ',{"QuestionId":2,"Value":"' || c_mktsegment || '","Comments":[]}' end
  || ']},"Society":{"Id":"society"}}]}' as document from customer""",
)
def json_documents(spark, d):
    """Nested documents; missing answers are left out, unmapped columns too."""
    rows = table(spark, d, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"), "c_name"
    )
    return sinks.answer_document(rows, ["c_custkey", "c_nationkey"], {"c_acctbal": 1, "segment": 2}, "form", "society")


@query("text_sinks", "select count(*) documents from customer")
def text_sinks(spark, d):
    """Documents and records written as text and counted."""
    path = shared_dir(spark, "text")
    documents = json_documents(spark, d)
    sinks.write_documents(documents, f"{path}/documents")
    sinks.write_records(documents.select(F.concat(F.col("id"), F.lit("END")).alias("record")), "record", f"{path}/records")
    written = spark.read.text([f"{path}/documents", f"{path}/records"])
    return written.agg(F.count(F.when(F.col("value").endswith("END"), 1)).alias("documents"))


@query(
    "written_texts",
    """select 'documents' as folder, '{"PersonInformation":{"IdentificationCode":"' || c_custkey || '_' || c_nationkey
  || '"},"Forms":[{"FormInstrument":{"Id":"form","Answers":[{"QuestionId":1,"Value":"' || cast(trunc(c_acctbal) as bigint) || '","Comments":[]}'
  || case when c_mktsegment = 'BUILDING' then '' else ',{"QuestionId":2,"Value":"' || c_mktsegment || '","Comments":[]}' end
  || ']},"Society":{"Id":"society"}}]}' as value from customer
union all select 'records', lpad(c_custkey::varchar, 10, ' ') || part from customer, (values ('CBC'), ('END')) t(part)""",
)
def written_texts(spark, d):
    """The text that the document and the record sinks wrote, line by line."""
    path, documents = shared_dir(spark, "text"), json_documents(spark, d)
    sinks.write_documents(documents, f"{path}/documents")
    key = F.lpad(F.col("c_custkey").cast("string"), 10, " ")
    records = table(spark, d, "customer").select(F.concat(key, F.lit("CBC\n"), key, F.lit("END")).alias("record"))
    sinks.write_records(records, "record", f"{path}/records")
    read = [spark.read.text(f"{path}/{name}").select(F.lit(name).alias("folder"), "value") for name in ("documents", "records")]
    return read[0].unionByName(read[1])


@query("job_of_path", "select o_orderkey, case when o_orderkey < 1000000 then 'job' || lpad(cast(o_orderkey as varchar), 6, '0') end job_id from orders")
def job_of_path(spark, d):
    number = F.col("o_orderkey")
    path = F.when(number < 1_000_000, F.concat(F.lit("/in/native_job"), F.lpad(number.cast("string"), 6, "0"), F.lit(".zip"))).otherwise("/in/none.zip")
    return table(spark, d, "orders").select("o_orderkey", labels.path_job(path).alias("job_id"))

"""Queries on input that looks like something else: numbers, dates, types, names and files."""

from pyspark.sql import functions as F

from longrec.functions import dates, values
from longrec.operators import columns, joins, ordered, recode, reshape
from longrec.plans import measures
from longrec.queries import query, table
from longrec.session import shared_dir
from longrec.sources import folders, reports, sinks
from longrec.streaming import jobs, upsert
from longrec.streaming.log import Files

# -- numbers and dates as text ------------------------------------------------------------

_NUMBER_SQL = """select o_orderkey, case o_orderkey % 8 when 0 then o_custkey || 'd' when 1 then o_custkey || 'F' when 2 then '0x1p3'
  when 3 then '12345678901234567' when 4 then ' ' || o_totalprice || ' ' when 5 then '-' || o_custkey when 6 then '1e3' else 'NaN' end as answer,
  case when o_orderkey % 8 = 0 then o_custkey || 'd' else '9007199254740993' end as long_id from orders"""
_IS_NUMBER = r"regexp_matches(answer, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')"


def _answers(spark, d):
    key, customer = F.col("o_orderkey") % 8, F.col("o_custkey").cast("string")
    answer = (
        F.when(key == 0, F.concat(customer, F.lit("d"))).when(key == 1, F.concat(customer, F.lit("F"))).when(key == 2, "0x1p3")
        .when(key == 3, "12345678901234567").when(key == 4, F.concat(F.lit(" "), F.col("o_totalprice").cast("string"), F.lit(" ")))
        .when(key == 5, F.concat(F.lit("-"), customer)).when(key == 6, "1e3").otherwise("NaN")
    )
    long_id = F.when(key == 0, F.concat(customer, F.lit("d"))).otherwise("9007199254740993")
    return table(spark, d, "orders").select("o_orderkey", answer.alias("answer"), long_id.alias("long_id"))


@query(
    "strict_numbers",
    f"""with a as ({_NUMBER_SQL}) select o_orderkey, case when {_IS_NUMBER} then try_cast(trim(answer) as double) end number,
  case when not {_IS_NUMBER} then answer when o_orderkey % 8 = 3 then '12345678901234567' else cast(cast(trunc(try_cast(trim(answer) as double)) as bigint) as varchar) end plain
from a""",
)
def strict_numbers(spark, d):
    """Identifiers that a cast would take for numbers stay text; long integers keep their digits."""
    text = F.col("answer")
    return _answers(spark, d).select("o_orderkey", values.to_number(text).alias("number"), values.plain_answer(text).alias("plain"))


@query(
    "strict_number_losses",
    f"""with a as ({_NUMBER_SQL}) select 'answer' column_name, 'double' kind, count(*) filter (not {_IS_NUMBER}) + count(*) filter (o_orderkey % 8 = 3) lost from a
union all select 'long_id', 'long', count(*) filter (o_orderkey % 8 = 0) from a""",
)
def strict_number_losses(spark, d):
    """Values that become null or lose digits are counted as lost; whole numbers beyond doubles are not."""
    plan = recode.plan_numeric_types(_answers(spark, d), ["answer", "long_id"])
    return spark.createDataFrame([(t.column, t.kind, t.lost) for t in plan], "column_name string, kind string, lost long")


@query(
    "strict_number_types",
    f"""with a as ({_NUMBER_SQL}) select o_orderkey, case when {_IS_NUMBER} then try_cast(trim(answer) as double) end answer,
  try_cast(long_id as bigint) long_id from a""",
)
def strict_number_types(spark, d):
    """A column of long integers keeps every digit."""
    rows = _answers(spark, d)
    return recode.apply_numeric_types(rows, recode.plan_numeric_types(rows, ["answer", "long_id"]))


_DATE_FORMS = [
    ("%Y-%m-%d", "yyyy-MM-dd"), ("%m/%d/%Y", "MM/dd/yyyy"), ("%Y/%m/%d", "yyyy/MM/dd"), ("%Y%m%d", "yyyyMMdd"), ("%b %d, %Y", "MMM dd, yyyy"),
    ("%B %d, %Y", "MMMM dd, yyyy"), ("%d %b %Y", "dd MMM yyyy"), ("%m/%d/%Y 3:00", "MM/dd/yyyy' 3:00'"),
]


@query(
    "text_dates",
    "select o_orderkey, case when o_orderkey % 9 < 8 then o_orderdate + case when o_orderkey % 9 = 7 then interval 3 hour else interval 0 hour end end as moment from orders",
)
def text_dates(spark, d):
    """Dates written in eight ways, and text that is none."""
    written = F.lit("not a date")
    for k, (_, form) in enumerate(_DATE_FORMS):
        written = F.when(F.col("o_orderkey") % 9 == k, F.date_format("o_orderdate", form)).otherwise(written)
    return table(spark, d, "orders").select("o_orderkey", dates.parse_date(written).alias("moment"))


_FORMS = ["MMM d yyyy", "d-MMM-yyyy", "MM-dd-yyyy", "M/d/yyyy 3:00 'PM'", "yyyy-MM", "d/M/yyyy", "MMM d, yyyy", "d MMMM yyyy", "yyyy.M.d", "EEEE, MMMM d, yyyy 15:30:05.25"]


def _written_dates(spark, d):
    """Two columns of dates in ten ways each, one with the day and one with the month first; and one that never tells."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate")

    def written(forms):
        text = F.lit("pending")
        for k, form in enumerate(forms):
            text = F.when(key % 11 == k, F.date_format(day, form)).otherwise(text)
        return text

    day_forms = [f.replace("MM-dd", "dd-MM").replace("M/d", "d/M") for f in _FORMS]
    month_forms = [f.replace("d/M", "M/d") for f in _FORMS]
    early = F.when(F.dayofmonth(day) <= 12, F.date_format(day, "M/d/yy"))
    return table(spark, d, "orders").select("o_orderkey", written(day_forms).alias("days"), written(month_forms).alias("months"), early.alias("open"))


_MOMENT = """case when o_orderkey % 11 = 10 then null when o_orderkey % 11 = 3 then o_orderdate + interval 15 hour when o_orderkey % 11 = 4 then date_trunc('month', o_orderdate)
  when o_orderkey % 11 = 9 then o_orderdate + interval '15 hours 30 minutes 5 seconds 250 milliseconds' else o_orderdate end"""


@query(
    "dates_by_column",
    f"select o_orderkey, ({_MOMENT})::timestamp as days, ({_MOMENT})::timestamp as months, case when day(o_orderdate) <= 12 then o_orderdate::timestamp end as open from orders",
)
def dates_by_column(spark, d):
    """The order of day and month is that of the column."""
    return dates.read_dates(_written_dates(spark, d), ["days", "months", "open"])


_NUMERIC = "o_orderkey % 11 in (2, 3, 5)"


@query(
    "date_plans",
    f"""with o as (select *, day(o_orderdate) d, month(o_orderdate) m from orders)
select 'days' as column_name, true as day_first, false as ambiguous, count(*) as n, count(*) filter (o_orderkey % 11 = 10) as unread,
  count(*) filter ({_NUMERIC} and d > 12) as day_proofs, 0::bigint as month_proofs, count(*) filter ({_NUMERIC} and d <= 12 and d <> m) as open from o
union all select 'months', false, false, count(*), count(*) filter (o_orderkey % 11 = 10), 0, count(*) filter ({_NUMERIC} and d > 12),
  count(*) filter ({_NUMERIC} and d <= 12 and d <> m) from o
union all select 'open', false, true, count(*) filter (d <= 12), 0, 0, 0, count(*) filter (d <= 12 and d <> m) from o""",
)
def date_plans(spark, d):
    """What speaks for the order of each column; one that proves none is reported as ambiguous."""
    plans = dates.plan_dates(_written_dates(spark, d), ["days", "months", "open"])
    rows = [(p.column, p.day_first, p.ambiguous, p.values, p.unread, p.day_proofs, p.month_proofs, p.open) for p in plans]
    return spark.createDataFrame(rows, "column_name string, day_first boolean, ambiguous boolean, n long, unread long, day_proofs long, month_proofs long, open long")


# -- names --------------------------------------------------------------------------------


@query("rename_swapped", "select n_nationkey as n_regionkey, n_regionkey as n_nationkey, n_name from nation")
def rename_swapped(spark, d):
    """Two columns trade their names."""
    return columns.rename_by_table(table(spark, d, "nation"), {"n_nationkey": "n_regionkey", "n_regionkey": "n_nationkey", "n_name": None})


@query("rename_chained", "select n_nationkey as n_name, n_name as label, n_regionkey from nation")
def rename_chained(spark, d):
    """A new name that another column had before."""
    return columns.rename_from_lines(table(spark, d, "nation"), ["n_nationkey,n_name", "n_name,label", "", "x,"])


# -- many labels, order -------------------------------------------------------------------

_LABELS = 230


@query(
    "flatten_many_labels",
    "select l_suppkey, "
    + ", ".join(f'max(case when l_suppkey > 5 and l_partkey % {_LABELS} = {i} then l_quantity end) "p{i}_l_quantity"' for i in range(_LABELS))
    + " from lineitem group by 1",
)
def flatten_many_labels(spark, d):
    """More labels than a pivot tests row by row; subjects without any label keep their row."""
    label = F.when(F.col("l_suppkey") > 5, (F.col("l_partkey") % _LABELS).cast("int")).alias("label")
    rows = table(spark, d, "lineitem").select("l_suppkey", label, "l_quantity")
    return reshape.simple_flatten(rows, ["l_suppkey"], "label", "p", agg=F.max)


@query(
    "sorted_numbers",
    "select l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice, "
    "row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice) as position from lineitem",
)
def sorted_numbers(spark, d):
    """A table sorted by its key, and the place of each row in it."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"]
    return ordered.sorted_numbers(table(spark, d, "lineitem").select(*order), order)


# -- files --------------------------------------------------------------------------------


def _write_named(df, path, folder, file):
    """Write the rows of each (folder, file) to a file of that name below ``path``.

    Spark names its own files, so they are renamed through the file system they lie in; there are
    as many as nations.
    """
    spark = df.sparkSession
    df.repartition(folder, file).write.partitionBy(folder, file).csv(f"{path}/.written", header=True, sep=";")
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{path}/.written")
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for at in system.globStatus(hadoop.Path(root, "*/*/part-*")):
        part = at.getPath()
        name, place = (p.getName().split("=", 1)[1] for p in (part.getParent(), part.getParent().getParent()))
        system.mkdirs(hadoop.Path(f"{path}/{place}"))
        system.rename(part, hadoop.Path(f"{path}/{place}/{name}"))
    system.delete(root, True)


_VISIT = "'visit' || (n_regionkey + 1)"


@query("file_listing", f"select 'nat' || n_nationkey as subject, {_VISIT} as visit from nation where n_regionkey < 3")
def file_listing(spark, d):
    """Subjects and visits from the files of a folder; files of other names are left out."""
    key, region = F.col("n_nationkey").cast("string"), F.col("n_regionkey")
    visit = F.concat(F.lit("nat"), key, F.lit("_visit"), (region + 1).cast("string"), F.lit(".csv"))
    other = F.concat(F.lit("other"), key, F.lit(".csv"))
    path = shared_dir(spark, "listing")
    rows = table(spark, d, "nation").select("n_name", F.lit("in").alias("folder"), F.when(region < 3, visit).otherwise(other).alias("file"))
    _write_named(rows, path, "folder", "file")
    return folders.discover_files(spark, path, "nat", "csv").select("subject", "visit")


@query(
    "job_collect_report_folder",
    """with r as (select n_nationkey, n_regionkey, n_name, 'brain' part from nation union all select n_nationkey, n_regionkey, n_name, 'crus' from nation)
select 'nat' || n_nationkey || '_s1' "Patient ID", 'nat' || n_nationkey "Subject", 'job' || lpad(cast(n_nationkey as varchar), 6, '0') job_id,
  cast(20 + n_regionkey as varchar) "Age", 'F' "Sex", case when part = 'brain' then 'subcortical' else 'ceres' end as type,
  case when part = 'brain' then n_nationkey + 100 end::bigint "Brainstem", case when part = 'crus' then n_nationkey + 200 end::bigint "Crus I" from r""",
)
def job_collect_report_folder(spark, d):
    """Jobs with two reports of different kinds and a table that is no report."""
    key = F.col("n_nationkey").cast("string")
    folder = F.concat(F.lit("nat"), key, F.lit("_s1-job"), F.lpad(key, 6, "0")).alias("folder")
    shared = [(F.col("n_regionkey") + 20).alias("Age"), F.lit("F").alias("Sex")]
    path, nations = shared_dir(spark, "jobs"), table(spark, d, "nation")
    for file, column, number in (("report_a.csv", "Brainstem", 100), ("report_b.csv", "Crus I", 200), ("volumes.csv", "Other", 300)):
        rows = nations.select(folder, F.lit(file).alias("file"), *shared, (F.col("n_nationkey") + number).alias(column))
        _write_named(rows, f"{path}/{column[:2]}", "folder", "file")
    return measures.collect_report_folder(spark, path, patient_pattern=r"nat\d+_s\d")


@query(
    "folder_scan_quoted",
    """select n_nationkey::bigint as id, n_name || '|' || n_regionkey as "a|b", case when n_regionkey > 1 then '"' || n_name || '"' end as "c" from nation
union all select null, 'a|b', 'c'""",
)
def folder_scan_quoted(spark, d):
    """Bars as separators, also inside quoted headers and values; a later line like the header is a row."""
    path = shared_dir(spark, "quoted")
    name, region = F.col("n_name"), F.col("n_regionkey")
    rows = table(spark, d, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"), F.concat(name, F.lit("|"), region.cast("string")).alias("a|b"),
        F.when(region > 1, F.concat(F.lit('"'), name, F.lit('"'))).alias("c"),
    )
    repeated = spark.range(1).select(F.lit("NaN").alias("id"), F.lit("a|b").alias("a|b"), F.lit("c").alias("c"))
    for part in (rows.where(region > 1), rows.where(region <= 1).unionByName(repeated)):
        part.coalesce(1).write.mode("append").option("escape", '"').csv(path, header=True, sep="|")
    return folders.scan_folder(spark, path, "id", sep="|")[0].drop(*folders.FILE_ORDER)


def _write_headed(lines, header, path, files):
    """Lines as this number of text files, each below a first line of its own."""
    number = (F.monotonically_increasing_id() % files).alias("part")
    first = lines.sparkSession.range(files).select(F.lit(header).alias("line"), F.col("id").alias("part"), F.lit(0).alias("place"))
    headed = first.unionByName(lines.select("line", number, F.lit(1).alias("place")))
    headed = headed.repartition(files, "part").sortWithinPartitions("part", "place").drop("place")
    headed.write.mode("append").partitionBy("part").text(path)


@query(
    "folder_scan_line_breaks",
    """select l_orderkey, l_linenumber::bigint l_linenumber, case l_linenumber % 3 when 0 then l_returnflag || chr(10) || '"' || l_linestatus || '",' || chr(10) || 'x'
  when 1 then l_linestatus || '" pipe' else l_shipdate::date::varchar end as note, case when l_returnflag <> 'R' then l_partkey end part from lineitem""",
)
def folder_scan_line_breaks(spark, d):
    """Line breaks inside quotes, in files of several splits; a third file has a quote that never closes."""
    path, rows = shared_dir(spark, "breaks"), table(spark, d, "lineitem")
    kind, state, day = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_shipdate").cast("date").cast("string")
    quoted = F.concat(F.lit('"'), kind, F.lit('\n""'), state, F.lit('"",\nx"'))
    third = F.col("l_linenumber") % 3
    note = F.when(third == 0, quoted).when(third == 1, F.concat(state, F.lit('" pipe'))).otherwise(day)
    key, number, pad = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.repeat(F.lit("-"), F.lit(90))
    returned = kind == "R"
    with_part = F.concat_ws(",", key, note, F.col("l_partkey").cast("string"), number, pad)
    for chosen, line, header in ((~returned, with_part, "l_orderkey,note,part,l_linenumber,pad"), (returned, F.concat_ws(",", number, note, key, pad), "l_linenumber,note,l_orderkey,pad")):
        _write_headed(rows.where(chosen).select(line.alias("line")), header, path, -(-rows.count() // 2_000_000))
    never = spark.range(1).select(F.lit('l_orderkey,note\n1,"open\n2,x').alias("line"))
    never.write.mode("append").text(path)
    found, skipped = folders.scan_folder(spark, path, "l_orderkey", "part-*")
    assert [r["reason"] for r in skipped.collect()] == ["a quoted field never ends"]
    return found.drop("pad", *folders.FILE_ORDER)


# -- the store ----------------------------------------------------------------------------


@query(
    "store_types",
    """select type, o_custkey, o_orderkey from (select case o_orderstatus when 'F' then '007' when 'O' then '7' end as type, o_custkey, o_orderkey,
  row_number() over (partition by o_orderstatus, o_custkey order by o_orderkey desc) rn from orders) where rn = 1""",
)
def store_types(spark, d):
    """Types that look like the same number, and no type at all, stay apart."""
    status = F.col("o_orderstatus")
    rows = table(spark, d, "orders").select(
        F.when(status == "F", "007").when(status == "O", "7").alias("type"), "o_custkey", "o_orderkey"
    )
    store, keys = shared_dir(spark, "types"), ["type", "o_custkey"]
    for batch, half in enumerate((F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 2 == 1)):
        upsert.upsert_batch(rows.where(half), store, batch, keys, ["o_orderkey"])
    upsert.compact(spark, store, 1, keys, ["o_orderkey"])
    return reports.upsert_reports(None, upsert.read_store(spark, store, keys, ["o_orderkey"]).unionByName(rows), keys, ["o_orderkey"])


@query("sorted_csv", "select s_suppkey::bigint s_suppkey, s_name, s_nationkey::bigint s_nationkey, s_acctbal, row_number() over (order by s_suppkey) as place from supplier")
def sorted_csv(spark, d):
    """Files sorted by their key over the whole folder: the place of a row in them is its rank."""
    path = shared_dir(spark, "sorted")
    sinks.write_csv(table(spark, d, "supplier"), path, ["s_suppkey"], sort=True)
    rows, _ = folders.scan_folder(spark, path, "s_suppkey", types={"s_suppkey": "long", "s_nationkey": "long", "s_acctbal": "double"})
    return ordered.sorted_numbers(rows, folders.FILE_ORDER, "place").drop(*folders.FILE_ORDER)


# -- types of columns that come together -----------------------------------------------------

_BIG = 9007199254740993  # the first whole number that no double holds


@query(
    "union_exact_numbers",
    f"""select o_orderkey + {_BIG} as id, o_custkey::decimal(21,2) as n, o_totalprice::varchar as x, null::bigint as part from orders
union all select l_orderkey, null, null, l_partkey from lineitem where l_linenumber = 1
union all select c_custkey, c_acctbal::decimal(21,2), (c_custkey + {_BIG})::varchar, null from customer""",
)
def union_exact_numbers(spark, d):
    """Longs with ints, longs with decimals, and longs with doubles that cannot hold them."""
    orders = table(spark, d, "orders").select(
        (F.col("o_orderkey") + F.lit(_BIG)).alias("id"), F.col("o_custkey").cast("long").alias("n"), F.col("o_totalprice").alias("x")
    )
    lines = table(spark, d, "lineitem").where("l_linenumber = 1")
    lines = lines.select(F.col("l_orderkey").cast("int").alias("id"), F.col("l_partkey").cast("int").alias("part"))
    people = table(spark, d, "customer").select(
        F.col("c_custkey").cast("int").alias("id"), F.col("c_acctbal").cast("decimal(12,2)").alias("n"), (F.col("c_custkey") + F.lit(_BIG)).alias("x")
    )
    return joins.union_missing(orders, lines, people).withColumn("part", F.col("part").cast("long"))


@query(
    "expand_exact_numbers",
    f"""select c_custkey, 's1' session_number, c_custkey + {_BIG} as code, c_acctbal as value from customer
union all select c_custkey, 's2', c_nationkey, c_nationkey::double from customer""",
)
def expand_exact_numbers(spark, d):
    """Sessions whose columns differ in their types: ids keep every digit, small longs meet doubles as doubles."""
    wide = table(spark, d, "customer").select(
        "c_custkey", (F.col("c_custkey") + F.lit(_BIG)).alias("s1_code"), F.col("c_nationkey").cast("int").alias("s2_code"),
        F.col("c_acctbal").alias("s1_value"), F.col("c_nationkey").cast("long").alias("s2_value"),
    )
    return reshape.expand(wide, "c_custkey")[0]


# -- jobs as a stream ---------------------------------------------------------------------------


@query(
    "stream_of_jobs",
    """select 'nat' || n_nationkey || '_s1' "Patient ID", 'nat' || n_nationkey "Subject",
  'job' || lpad(cast(case when n_regionkey = 2 then 100 else 0 end + n_nationkey as varchar), 6, '0') job_id, cast(20 + n_regionkey as varchar) "Age", 'F' "Sex",
  case when n_regionkey < 3 then 'subcortical' else 'hips_kulaga_multicontrast' end as type, case when n_regionkey < 3 then n_nationkey + case when n_regionkey = 2 then 200 else 100 end end::bigint "Brainstem",
  case when n_regionkey >= 3 then n_name || chr(10) || n_regionkey end as note from nation""",
)
def stream_of_jobs(spark, d):
    """Two arrivals with a restart in between: the second one sends a job of the first again, changed, and a later job of region 2's patients."""
    base, nations = shared_dir(spark, "arrivals"), table(spark, d, "nation")
    files, rows = Files(spark, f"{base}/in"), nations.select("n_nationkey", "n_regionkey", "n_name").collect()

    def send(place, job, nation, region, header, line, *more):
        folder = f"{place}/nat{nation}_s1-job{job:06d}"
        files.create(f"{folder}/report.csv", f"Age;Sex;{header}\n{20 + region};F;{line}\n")
        for name in more:
            files.create(f"{folder}/{name}", "x")

    for arrival in (1, 2):
        for nation, region, name in rows:
            if arrival == 1 and region < 3:
                send("first", nation, nation, region, "Brainstem", nation + 100, "scan_t2.nii")
            elif arrival == 2 and region >= 3:
                send("second", nation, nation, region, "note", f'"{name}\n{region}"', "scan_t2.nii")
            elif arrival == 2:
                send("again", nation, nation, region, "Brainstem", -1)
                if region == 2:
                    send("second", nation + 100, nation, region, "Brainstem", nation + 200)
        jobs.stream_jobs(spark, f"{base}/in", f"{base}/store", f"{base}/checkpoint", r"nat\d+_s\d", files_per_batch=40).awaitTermination()
    return jobs.stored_reports(spark, f"{base}/store")

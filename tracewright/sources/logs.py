"""Sources: text lines, event tables as logs, ground truth, synthetic data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import expr as X
from . import files, sinks
from .scratch import staged


def require_columns(df: DataFrame, columns: list[str], what: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df


def stage_files(spark: SparkSession, source: str, target: str, move: bool = False) -> list[str]:
    """Copy or move one file, or all *.log and then *.txt below a folder, into ``target``; works on any file system."""
    if not files.exists(spark, source):
        raise FileNotFoundError(source)
    found = [*files.listed(spark, source, "*.log", below=True), *files.listed(spark, source, "*.txt", below=True)] if files.is_folder(spark, source) else [source]
    if not found:
        raise ValueError(f"no log files below {source}")
    done = []
    for f in found:
        done.append(f"{target.rstrip('/')}/{f.rsplit('/', 1)[1]}")
        files.copy(spark, f, done[-1], move)
    return done


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value) of a text file, or of all *.log and *.txt files below a folder; ``block`` is where in the file its part begins."""
    read = spark.read.option("recursiveFileLookup", "true")
    read = read.option("pathGlobFilter", "*.{log,txt}") if files.is_folder(spark, path) else read
    return read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table; a clear error if it is missing."""
    sinks.recover(spark, path)
    if not files.exists(spark, path):
        raise FileNotFoundError(f"{path}: run the stage that writes it first")
    return spark.read.parquet(path)


def read_ground_truth(spark: SparkSession, folder: str) -> DataFrame:
    """(sequence_number, true_label) from ground_truth.parquet, else .csv, below ``folder``."""
    for name, read in (("ground_truth.parquet", spark.read.parquet), ("ground_truth.csv", spark.read.option("header", "true").csv)):
        try:
            df = read_table(spark, f"{folder}/{name}") if name.endswith("parquet") else read(f"{folder}/{name}")
            return df.select(F.col("sequence_number").cast("long").alias("sequence_number"), "true_label")
        except Exception as e:  # noqa: BLE001  # Spark raises its own kinds for missing paths
            if not isinstance(e, FileNotFoundError) and "PATH_NOT_FOUND" not in str(e):
                raise
    raise FileNotFoundError(f"no ground_truth.parquet or ground_truth.csv in {folder}")


#: Parts of the input up to which their table is broadcast.
FEW_PARTS = 100_000


def number_lines(lines: DataFrame, keep: Column | None = None) -> DataFrame:
    """Dense numbers from 1 in file order over the rows where ``keep`` holds.

    Files come in the order of their names and parts of a file by where they begin, if
    ``lines`` tells (columns file and block), else parts as the scan has them.  Rows
    are written once with their place, so that numbers do not change when a lost task
    runs again; a number is a row's place in its part and a count of the parts before.
    """
    rows = lines.filter(keep) if keep is not None else lines
    at = F.monotonically_increasing_id()
    part = ["file", "block"] if {"file", "block"} <= set(lines.columns) else ["_part"]
    tagged = staged(rows.select(at.alias("_at"), F.shiftright(at, 33).alias("_part"), *lines.columns), "lines")
    parts = tagged.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    order = Window.orderBy(*part)  # over the parts of the input, not its rows
    parts = parts.select(*[F.col(c).alias(f"_{c}_key") for c in part], "_first", (F.sum("_n").over(order) - F.col("_n")).alias("_before"))
    parts = staged(parts, "parts")
    parts = F.broadcast(parts) if parts.count() <= FEW_PARTS else parts
    both = tagged.join(parts, [F.col(c).eqNullSafe(F.col(f"_{c}_key")) for c in part])
    return both.select((F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("sequence_number"), *lines.columns)


ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}\s+."
BSD = r"^[A-Z][a-z]{2}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2}\s+."


def parse_timestamp(lines: DataFrame, column: str, year: int | None = None) -> DataFrame:
    """``lines`` with timestamp and rest (what follows) of an ISO or BSD time at the start; null where neither stands there.

    A line is matched and cut once; every later step reads columns.
    """
    line, parts = F.col(column), F.col("_parts")
    y = F.lit(str(year)) if year else F.year(F.current_date()).cast("string")
    kind = F.when(line.rlike(ISO), "iso").when(line.rlike(BSD), "bsd")
    cut = lines.withColumn("_kind", kind).withColumn("_parts", F.when(F.col("_kind") == "bsd", F.split(line, r"\s+", 4)))
    iso_text = F.concat(F.left(line, F.lit(10)), F.lit(" "), F.substring(line, 12, 8))
    bsd_text = F.concat_ws(" ", y, F.get(parts, F.lit(0)), F.lpad(F.get(parts, F.lit(1)), 2, "0"), F.get(parts, F.lit(2)))
    ts = F.when(F.col("_kind") == "iso", F.try_to_timestamp(iso_text, F.lit("yyyy-MM-dd HH:mm:ss"))).when(F.col("_kind") == "bsd", F.try_to_timestamp(bsd_text, F.lit("yyyy MMM dd HH:mm:ss")))
    rest = F.when(F.col("_kind") == "iso", F.regexp_replace(F.substring(line, 20, 1 << 30), r"^\s+", "")).otherwise(F.coalesce(F.get(parts, F.lit(3)), F.lit("")))
    return cut.withColumns({"timestamp": ts.cast("timestamp_ntz"), "rest": rest}).drop("_kind", "_parts")


def normalize(lines: DataFrame, column: str = "value", year: int | None = None) -> DataFrame:
    """Syslog fields of each line; ``timestamp`` is null for lines that do not parse.

    Blank lines, comments, fractional seconds and version fields do not parse.
    """
    staged = lines.withColumn("raw_text", F.trim(F.col(column)))
    staged = staged.withColumns({"_pri": X.pri_severity(F.col("raw_text")), "_line": F.regexp_replace("raw_text", r"^<\d{1,3}>", "")})
    staged = parse_timestamp(staged, "_line", year)
    staged = staged.withColumn("timestamp", X.once(F.when(~F.startswith("raw_text", F.lit("#")), F.col("timestamp")))).withColumn("_cut", F.split("rest", r"\s+", 2))
    host = F.get("_cut", F.lit(0))
    staged = staged.withColumns({"host": F.when(host == "", "unknown").otherwise(host), "rest": F.coalesce(F.get("_cut", F.lit(1)), F.lit(""))})
    staged = staged.withColumns({"_name": X.service_name(F.col("rest")), "message": X.message_of(F.col("rest"))})
    staged = staged.withColumns({"service": X.service_alias(F.col("_name")), "log_level": X.severity_of(F.col("message"), F.col("_pri"))})
    return staged.withColumn("message", X.clean_message(F.col("message"))).drop("rest", "_pri", "_line", "_cut", "_name")


def parsed_lines(lines: DataFrame, column: str = "value", year: int | None = None) -> DataFrame:
    return normalize(lines, column, year).filter("timestamp is not null")


def events_as_logs(events: DataFrame, hosts: int = 13, config: Config = DEFAULT) -> DataFrame:
    """The event table as parsed logs: host from the user, template from the type."""
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "purchase", "WARN").otherwise("INFO")
    return events.select(
        (F.col("event_id") + 1).cast("long").alias("sequence_number"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("sw-"), F.lpad((F.col("user_id") % hosts).cast("string"), 2, "0")).alias("host"),
        level.alias("log_level"),
        F.upper("event_type").alias("service"),
        F.col("event_type").alias("template_id"),
        X.event_weight(level, config).alias("event_weight"),
        F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("message"),
        F.col("value").cast("double").alias("value"),
    )


def syslog_lines(events: DataFrame, hosts: int = 13) -> DataFrame:
    """Raw lines made from events: half BSD, half ISO times, with PRI codes, services and process numbers."""
    pri = F.format_string("<%d>", F.col("event_id") % 192)
    iso = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    bsd = F.concat_ws(" ", F.date_format("ts", "MMM"), F.lpad(F.dayofmonth("ts").cast("string"), 2, " "), F.date_format("ts", "HH:mm:ss"))
    service = F.element_at(F.array(*[F.lit(s) for s in ("sshd", "snmpd", "eventmgr", "ospf", "cfgd")]), (F.col("event_id") % 5 + 1).cast("int"))
    text = F.concat_ws(" ", F.lit("user"), F.col("user_id").cast("string"), "event_type", F.when(F.col("event_id") % 7 == 0, "login failed").when(F.col("event_id") % 7 == 1, "warning seen").otherwise("done"))
    host = F.concat(F.lit("sw-"), F.lpad((F.col("user_id") % hosts).cast("string"), 2, "0"))
    line = F.concat(pri, F.when(F.col("event_id") % 2 == 0, iso).otherwise(bsd), F.lit(" "), host, F.lit(" "), service, F.lit("["), F.col("user_id").cast("string"), F.lit("]: "), text)
    return events.select("event_id", "ts", line.alias("value"))


#: Messages of the synthetic source: a service, then what it says.
NORMAL = (
    "OSPF: neighbor state changed to FULL", "OSPF: adjacency established with 10.0.0.2", "lldpd: neighbor added on port 1/1/5", "lldpd: neighbor refreshed on port 1/1/6",
    "snmpd: poll completed in 12ms", "snmpd: walk of 40 objects done", "sshd[812]: login successful for admin", "sshd[813]: connection closed by 10.0.0.9",
    "cfgd: configuration saved", "cfgd: checkpoint written", "eventmgr: port 1/1/2 changed state to up", "eventmgr: vlan 20 added", "kernel: fan speed set to 40%", "cron[77]: job rotate finished",
)
ODD = (
    "eventmgr: Interface bandwidth threshold exceeded on 1/1/3", "eventmgr: port 1/1/9 changed state to down", "eventmgr: link flap on 1/1/4", "OSPF: adjacency lost with 10.0.0.7",
    "sshd[814]: authentication failure for root", "kernel: temperature above threshold", "kernel: disk write latency 900ms", "snmpd: cpu utilization exceeds 95%", "eventmgr: packet drop rate high on 1/1/8", "cfgd: ACL error in rule 12",
)


def synthetic_lines(spark: SparkSession, hosts: int = 13, events: int = 200, seed: int = 42) -> DataFrame:
    """Seeded BSD syslog lines: exponential gaps of mean 1/0.3 s, 15 % anomaly patterns."""
    draw = lambda turn: X.draw(F.col("id"), turn, seed)
    ids = spark.range(hosts * events).withColumns({"h": F.col("id") % hosts, "n": F.floor(F.col("id") / hosts)})
    gaps = ids.withColumn("gap", -F.log(draw(1)) / 0.3)
    at = F.sum("gap").over(Window.partitionBy("h").orderBy("n"))
    pick = lambda xs, turn: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.floor(draw(turn) * len(xs)) + 1).cast("int"))
    when = F.timestamp_add("SECOND", F.floor(at).cast("long"), F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
    made = gaps.select("id", "h", "n", when.alias("t"), (draw(2) < 0.15).alias("is_anomaly"), pick(ODD, 3).alias("odd"), pick(NORMAL, 4).alias("plain"))
    text = F.when(F.col("is_anomaly"), F.col("odd")).otherwise(F.col("plain"))
    return made.select("id", F.concat(F.lit("<134>"), F.date_format("t", "MMM dd HH:mm:ss"), F.lit(" sw-"), F.lpad("h", 2, "0"), F.lit(" "), text).alias("value"), "is_anomaly")


def feature_scenario(spark: SparkSession, rows: int = 300, odd_from: int = 270) -> DataFrame:
    """Feature rows of which the last ones are forced to be anomalous."""
    odd = F.col("id") >= odd_from
    noise = lambda turn: F.round(X.draw(F.col("id"), turn), 3)
    return spark.range(rows).select(
        (F.col("id") + 1).alias("sequence_number"),
        F.concat(F.lit("s"), F.floor(F.col("id") / 30).cast("string")).alias("session_id"),
        F.when(odd, 0.95 + noise(1) / 20).otherwise(noise(1) / 2).alias("frequency_score"),
        F.when(odd, 8 + noise(2)).otherwise(noise(2)).alias("burstiness_score"),
        F.when(odd, 4 + noise(3)).otherwise(noise(3) - 0.5).alias("zscore_base"),
        odd.alias("forced"),
    )


def benchmark_rows(spark: SparkSession, n: int) -> DataFrame:
    """n rows a second apart with pseudo-random component scores."""
    draw = lambda turn: X.draw(F.col("id"), turn)
    at = F.timestamp_add("SECOND", F.col("id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return spark.range(n).select(F.col("id").alias("log_id"), at.alias("timestamp"), draw(1).alias("anomaly_score"), draw(2).alias("centrality_score"), draw(3).alias("temporal_score"))


def benchmark_score(rows: DataFrame) -> DataFrame:
    """Reference workload of the latency harness: a weighted score, its label, an incident per 25 rows."""
    score = 0.4 * F.col("anomaly_score") + 0.35 * F.col("centrality_score") + 0.25 * F.col("temporal_score")
    incident = F.concat(F.lit("INC-"), F.lpad(F.floor(F.col("log_id") / 25).cast("string"), 4, "0"))
    return rows.withColumn("final_score", score).withColumns({"label": X.label_of(F.col("final_score")), "incident_id": incident})

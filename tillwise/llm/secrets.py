"""Secret scans over an incremental ledger of text blobs.

Every historical version of a document is addressed by the SHA-256 of its text. The
ledger holds one row per (blob, rule version) that was ever scanned, with the spans
found. A run scans only the pairs the ledger lacks, and joins the findings back to every
path (document row) that holds the blob, so a copied text is scanned once however often
it occurs. All of it is DataFrame work.

Results: a null text counts as empty and has no findings; repeated rows and repeated
ids each get their own row; a table without rows gives none; other columns of the
input play no part and may carry any name.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.llm.tables import fresh, table
from tillwise.session import working_folder


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``pattern`` has two groups, which together are the match; matches
    whose second group has fewer than ``least`` characters are dropped. Matches are the
    leftmost non-overlapping ones of the pattern, dropped ones included."""

    kind: str
    version: int
    pattern: str
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)"""
                      r"([A-Za-z0-9+/_.=-]+)", 8),
    # a match of these two is all of its run or ends it, so a short one hides no longer one
    # and the least length can stand in the pattern
    Rule("access", 1, r"()(AKIA[A-Z0-9]{12,})", 16),
    Rule("hex", 1, r"()([0-9a-f]{32,})", 32),
)

# Marks around matches. In the text they are replaced by a character that no rule
# matches either, so matches and offsets stay what they are.
_OPEN, _MID, _CLOSE, _PLAIN = "\x01", "\x02", "\x03", "~"

LEDGER_SCHEMA = "blob string, rule string, spans array<struct<start:int,end:int>>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _pieces(text: Column, rule: Rule) -> Column:
    """The text cut before every match, as (characters before the value, in the value,
    after the match). The first piece has no match and a value of -1."""
    marked = F.regexp_replace(F.translate(text, _OPEN + _MID + _CLOSE, _PLAIN * 3),
                              F.lit(rule.pattern), F.lit(f"{_OPEN}$1{_MID}$2{_CLOSE}"))
    def lengths(piece: Column) -> Column:
        match = F.substring_index(piece, _CLOSE, 1)
        lead = F.length(F.substring_index(match, _MID, 1))
        found = F.instr(piece, _CLOSE) > 0
        return F.struct(
            F.when(found, lead).otherwise(0).alias("lead"),
            F.when(found, F.length(match) - lead - 1).otherwise(-1).alias("value"),
            F.when(found, F.length(piece) - F.length(match) - 1)
             .otherwise(F.length(piece)).alias("tail"))
    return F.transform(F.split(marked, _OPEN, -1), lengths)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for ``blobs`` (blob, text, todo: keys of the rules to apply). Offsets are
    code points, the end is exclusive. Spans are in order of their start. Only a text in
    which a rule matches at all is cut into pieces for it."""
    todo = F.col("todo")
    whole = F.array(F.struct(F.lit(0).alias("lead"), F.lit(-1).alias("value"), F.lit(0).alias("tail")))
    per_rule = F.array(*[
        F.struct(F.lit(r.key).alias("rule"), F.lit(r.least).alias("least"),
                 F.when(F.array_contains(todo, r.key) & F.col("text").rlike(r.pattern),
                        _pieces(F.col("text"), r)).otherwise(whole).alias("pieces")) for r in rules])
    wanted = F.filter(per_rule, lambda x: F.array_contains(todo, x["rule"]))
    pieces = (blobs.select("blob", F.explode(wanted).alias("r"))
              .select("blob", "r.rule", "r.least", F.posexplode("r.pieces").alias("at", "p")))
    before = W.partitionBy("blob", "rule").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    size = F.col("p.lead") + F.greatest(F.col("p.value"), F.lit(0)) + F.col("p.tail")
    start = F.coalesce(F.sum(size).over(before), F.lit(0)).cast("int")
    spans = pieces.select(
        "blob", "rule",
        F.when(F.col("p.value") >= F.col("least"), F.struct(
            start.alias("start"),
            (start + F.col("p.lead") + F.col("p.value")).cast("int").alias("end"))).alias("span"))
    return spans.groupBy("blob", "rule").agg(
        F.sort_array(F.collect_list("span")).alias("spans"))


def ledger_folder(spark: SparkSession) -> str:
    """The folder that the session setting ``spark.tillwise.ledger`` names, in which every
    run finds what earlier ones have scanned; a fresh one without that setting."""
    return spark.conf.get("spark.tillwise.ledger", None) or working_folder(spark, "ledger")


def update_ledger(docs: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES,
                  text: str = "text") -> DataFrame:
    """Scan what the ledger in ``folder`` lacks, append it, and return the ledger.

    Rows are appended in one committed write per run, so a run that dies adds nothing and
    the next one scans its blobs again; a pair written twice by two runs at once holds
    the same spans twice, which ``findings`` reads once.
    """
    spark = docs.sparkSession
    keys = F.array(*[F.lit(r.key) for r in rules])
    blobs = (docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
             .withColumn("blob", blob_of(F.col("text")))
             .groupBy("blob").agg(F.first("text").alias("text")))
    known = read_ledger(spark, folder)
    if known is None:
        todo = blobs.withColumn("todo", keys)
    else:
        seen = known.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = (blobs.join(seen, "blob", "left")
                .withColumn("todo", F.array_except(keys, F.coalesce("seen", F.array().cast(
                    "array<string>"))))
                .where(F.size("todo") > 0).drop("seen"))
    scan(todo, rules).write.mode("append").parquet(folder)
    return read_ledger(spark, folder)


def read_ledger(spark: SparkSession, folder: str) -> DataFrame | None:
    """The ledger, or None if nothing was ever scanned into it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(LEDGER_SCHEMA).parquet(folder)


def findings(docs: DataFrame, ledger: DataFrame, name: str, rules: tuple[Rule, ...] = RULES,
             text: str = "text") -> DataFrame:
    """``docs`` with a column ``name``: array of (start, at, kind, end, past) by start, then kind as
    listed; ``past`` is the largest end so far. Null where a text has no secret: only blobs
    with findings take part in the join."""
    order = {r.key: (i, r.kind) for i, r in enumerate(rules)}
    at = F.coalesce(*[F.when(F.col("rule") == k, i) for k, (i, _) in order.items()])
    kind = F.coalesce(*[F.when(F.col("rule") == k, F.lit(n)) for k, (_, n) in order.items()])
    once = (ledger.where(F.col("rule").isin(*order)).groupBy("blob", "rule")
            .agg(F.max("spans").alias("spans")))
    spans = once.select("blob", at.alias("at"), kind.alias("kind"), F.explode("spans").alias("s"))
    before = (W.partitionBy("blob").orderBy("s.start", "at")
              .rowsBetween(W.unboundedPreceding, -1))
    found = (spans.withColumn("past", F.coalesce(F.max("s.end").over(before), F.lit(0)))
             .groupBy("blob").agg(F.sort_array(F.collect_list(F.struct(
                 F.col("s.start").alias("start"), "at", "kind", F.col("s.end").alias("end"),
                 "past"))).alias(name)))
    blob = fresh(docs, "blob")[0]
    return (docs.withColumn(blob, blob_of(F.col(text)))
            .join(found.withColumnRenamed("blob", blob), blob, "left").drop(blob))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document row: doc_id, spans per kind, the digest of all spans, and the spans."""
    spans = F.coalesce(F.col("_found"), F.array().cast(
        "array<struct<start:int,at:int,kind:string,end:int,past:int>>"))
    def count(kind: str) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long")
    return (findings(docs.select("doc_id", "text"), ledger, "_found", rules)
            .select("doc_id", spans.alias("_spans"))
            .select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in rules],
                    F.sha2(_joined(F.col("_spans")), 256).alias("base_sha256"),
                    _joined(F.col("_spans")).alias("spans")))


def redact(docs: DataFrame, ledger: DataFrame, mark: str = "[SECRET]",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``: overlapping or touching spans by one.
    ``n_chars``, if there, is that of the new text. Clean rows stay as they are."""
    found = fresh(docs, "found")[0]
    kept = F.transform(found, lambda s, i: F.when(
        (i == 0) | (s["start"] > s["past"]),
        F.concat(F.substring(F.col("text"), s["past"] + 1, s["start"] - s["past"]), F.lit(mark))
        ).otherwise(""))
    last = F.array_max(F.transform(found, lambda s: s["end"]))
    clean = F.concat(F.array_join(kept, ""),
                     F.substring(F.col("text"), last + 1, F.length("text")))
    done = findings(docs, ledger, found, rules)
    done = done.withColumn("text", F.when(F.col(found).isNull(), F.col("text")).otherwise(clean))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col(found).isNull(), F.col("n_chars"))
                               .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return done.select(*docs.columns)


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return report(docs, update_ledger(docs, ledger_folder(spark)))


_SQL_RULES = {  # the same patterns, with the cases spelt out
    "assign": (r"""(([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
               r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?)"""
               r"([A-Za-z0-9+/_.=-]+)", "\\3", 8, 0),
    "access": (r"()(AKIA[A-Z0-9]+)", "\\2", 16, 1),
    "hex": (r"()([0-9a-f]+)", "\\2", 32, 2),
}


def _sql() -> str:
    spans = " union all ".join(f"""
      select row_id, '{kind}' as kind, {at} as listed, lead_n, value_n, {least} as least,
             coalesce(sum(lead_n + greatest(value_n, 0) + tail_n) over (
               partition by row_id order by i rows between unbounded preceding and 1 preceding), 0) as start
      from (select row_id, i,
                   case when m then length(split_part(split_part(p, chr(3), 1), chr(2), 1)) else 0 end as lead_n,
                   case when m then length(split_part(split_part(p, chr(3), 1), chr(2), 2)) else -1 end as value_n,
                   case when m then length(split_part(p, chr(3), 2)) else length(p) end as tail_n
            from (select row_id, i, p, contains(p, chr(3)) as m
                  from (select row_id, unnest(range(1, len(ps) + 1)) as i, unnest(ps) as p
                        from (select row_id, string_split(regexp_replace(t, '{pattern}',
                                chr(1) || '\\1' || chr(2) || '{value}' || chr(3), 'g'), chr(1)) as ps
                              from d))))"""
        for kind, (pattern, value, least, at) in _SQL_RULES.items())
    return f"""
    with d as (select row_number() over () as row_id, doc_id,
                      translate(coalesce(text, ''), chr(1) || chr(2) || chr(3), '~~~') as t
               from documents),
    spans as ({spans}),
    kept as (select *, start + lead_n + value_n as stop from spans where value_n >= least),
    per_row as (select row_id, count(*) filter (kind = 'assign') as n_assign,
                       count(*) filter (kind = 'access') as n_access,
                       count(*) filter (kind = 'hex') as n_hex,
                       string_agg(kind || ':' || cast(start as bigint) || ':' || cast(stop as bigint),
                                  ',' order by start, listed) as spans
                from kept group by row_id)
    select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
           coalesce(n_hex, 0) as n_hex, sha256(coalesce(spans, '')) as base_sha256,
           coalesce(spans, '') as spans
    from d left join per_row using (row_id)"""


OP10_SQL = _sql()

"""Operator 7: secret scans over an incremental blob ledger. DataFrame functions only.

Every version of every path is content-addressed by the SHA-256 of its text. A ledger holds one row for each blob
and rule version already scanned: (blob_id, rule, findings). scan() takes the versions, leaves out the pairs that
the ledger has, scans each remaining blob once however many paths hold it, and returns both the new ledger rows
and the findings joined back to all paths. scan_stored() keeps the ledger as Parquet under a path: a run appends the
pairs that it scanned, in one commit, and reads all findings from there, so the next run over any versions scans only
what is new, be it a blob or a rule's version. Two runs at a time may scan a pair twice; its rows are equal.

Rules. A rule is a kind, a version and a Java regular expression. Matches are leftmost and non-overlapping for each
kind; spans are counted in code points, the end exclusive. A match that is too short (by its whole, or by the group
that holds the value) is dropped after matching, so it still consumes its characters.

Positions come from built-ins: each match is wrapped in a marker that no rule's character class holds, the text
is split at the markers, and the running sum of the pieces' lengths is the position. The sum is taken in two
levels so that a text with very many matches costs little more than its length.

Scale: blobs are made distinct by a partial aggregate before the shuffle, so a text that a third of all rows hold
leaves each map task once; the join back to the paths is an equi-join on blob_id that Spark may split.

Defined cases: null text is the empty text; a very long text is scanned whole, in one row; empty table gives no rows; rows with a null doc_id and repeated rows
each get a result row; extra columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm.common import if_small, materialize, pack


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    group: int  # its length is tested; 0: the whole match
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base kinds in the order in which equal starts are listed.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)

#: For the running sum: pieces in one block.
BLOCK = 512
MARK, OTHER = "\ue000", "\ue001"  # private use, in no rule's character class

FINDING = "struct<start:int,end:int>"
LEDGER = f"blob_id string, rule string, findings array<{FINDING}>"


class Scan(NamedTuple):
    new_entries: DataFrame  # ledger rows made by this run
    by_blob: DataFrame  # blob_id, findings: array<struct<kind, start, end>> in order; blobs without any are left out
    findings: DataFrame  # path columns, blob_id, findings; a row for every version


def find(text: Column, rule: Rule) -> Column:
    """array<struct<start,end>> of the rule's matches in text."""
    safe = F.translate(text, MARK, OTHER)
    pattern = rule.pattern
    if rule.group == 0 and rule.pattern.endswith("]+"):  # a run that is too short can't hold or hide a longer one
        prefix, _, char_class = rule.pattern[:-1].rpartition("[")
        pattern = f"{prefix}[{char_class}{{{rule.least - len(prefix)},}}"
    marked = F.regexp_replace(safe, F.lit(pattern), F.lit(f"{MARK}$0{MARK}"))

    def of(pieces: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / BLOCK).cast("int")), lambda b: F.transform(F.slice(pieces, b * BLOCK + 1, BLOCK), lambda p: F.struct(F.length(p).alias("n"), F.length(F.regexp_extract(p, rule.pattern, rule.group)).alias("m"))))

        def inside(block: Column) -> Column:
            """(length of the block, its pieces with starts relative to it)"""
            zero = F.struct(F.lit(0).alias("n"), F.array().cast("array<struct<start:int,end:int,m:int>>").alias("out"))
            return F.aggregate(block, zero, lambda a, p: F.struct((a["n"] + p["n"]).alias("n"), F.concat(a["out"], F.array(F.struct(a["n"].alias("start"), (a["n"] + p["n"]).alias("end"), p["m"].alias("m")))).alias("out")))

        zero = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("offsets"))
        summed = F.transform(blocks, inside)
        offsets = F.aggregate(summed, zero, lambda a, b: F.struct((a["n"] + b["n"]).alias("n"), F.concat(a["offsets"], F.array(a["n"])).alias("offsets")), lambda a: a["offsets"])
        placed = F.flatten(F.zip_with(summed, offsets, lambda b, o: F.transform(b["out"], lambda p: F.struct((p["start"] + o).alias("start"), (p["end"] + o).alias("end"), p["m"].alias("m")))))
        kept = F.filter(placed, lambda p, i: (i % 2 == 1) & (p["m"] >= rule.least))
        return F.transform(kept, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))

    # the array of one element binds the pieces to a name, so that they are computed once
    bound = F.element_at(F.transform(F.array(F.split(marked, MARK, -1)), of), 1)
    return F.when(text.rlike(pattern), bound).otherwise(F.array().cast(f"array<{FINDING}>"))


def address(versions: DataFrame) -> DataFrame:
    """Each row packed, with its text (null: empty) and the text's content address."""
    return pack(versions).withColumn("text", F.coalesce(F.col("__row.text"), F.lit(""))).withColumn("blob_id", F.sha2("text", 256))


def scan(versions: DataFrame, paths: list[str], ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> Scan:
    """versions: the path columns and text, one row for each version of each path."""
    addressed = address(versions)
    blobs = addressed.groupBy("blob_id").agg(F.first("text").alias("text"))
    new = unseen(blobs, ledger, rules)
    known = new if ledger is None else new.unionByName(ledger.where(F.col("rule").isin([r.key for r in rules])).select("blob_id", "rule", "findings").distinct())
    by_blob = materialize(listed(known, rules), "findings")  # broadcast by its true size, or a join whose hot blobs can be split
    return Scan(new, by_blob, back_to_paths(addressed, by_blob, paths))


def unseen(blobs: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows for the pairs of blob and rule that the ledger hasn't."""
    every = F.array(*[F.lit(r.key) for r in rules])
    if ledger is None:
        todo = blobs.withColumn("todo", every)
    else:
        seen = ledger.groupBy("blob_id").agg(F.collect_set("rule").alias("seen"))
        todo = blobs.join(seen, "blob_id", "left").withColumn("todo", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))).where(F.size("todo") > 0)
    found = [F.when(F.array_contains("todo", r.key), F.struct(F.lit(r.key).alias("rule"), find(F.col("text"), r).alias("findings"))) for r in rules]
    return todo.select("blob_id", F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())))


def listed(known: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows to blob_id, findings; blobs without any are left out."""
    order = {r.key: i for i, r in enumerate(rules)}
    rank = F.coalesce(*[F.when(F.col("rule") == k, F.lit(i)) for k, i in order.items()])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    held = known.where(F.size("findings") > 0).select("blob_id", F.transform("findings", lambda f: F.struct(f["start"].alias("start"), rank.alias("rank"), f["end"].alias("end"))).alias("found"))
    by_blob = held.groupBy("blob_id").agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))
    return by_blob.select("blob_id", F.transform("found", lambda f: F.struct(F.element_at(kinds, f["rank"] + 1).alias("kind"), f["start"].alias("start"), f["end"].alias("end"))).alias("findings"))


def back_to_paths(addressed: DataFrame, by_blob: DataFrame, paths: list[str]) -> DataFrame:
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    named = addressed.select(*[F.col("__row").getField(p).alias(p) for p in paths], "blob_id")
    return named.join(by_blob, "blob_id", "left").select(*paths, "blob_id", F.coalesce("findings", empty).alias("findings"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger stored under path; empty if there is none yet."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in (("blob_id", "string"), ("rule", "string"), ("findings", f"array<{FINDING}>"))])
    return spark.read.schema(LEDGER).parquet(path)


def scan_stored(versions: DataFrame, paths: list[str], path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The findings (path columns, blob_id, findings) of every version, by the ledger stored under path, which this brings up to date."""
    spark, addressed = versions.sparkSession, address(versions)
    blobs = addressed.groupBy("blob_id").agg(F.first("text").alias("text"))
    unseen(blobs, read_ledger(spark, path), rules).write.mode("append").parquet(path)
    known = read_ledger(spark, path).where(F.col("rule").isin([r.key for r in rules]) & (F.size("findings") > 0)).distinct()
    return back_to_paths(addressed, materialize(listed(known, rules), "findings"), paths)


def spans_text(findings: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def digest(findings: DataFrame) -> DataFrame:
    """The contract's columns."""
    def n(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")

    text = spans_text(F.col("findings"))
    return findings.select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"), F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


def redact(docs: DataFrame, replacement: str = "[SECRET]", ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with every span that scan() finds replaced; overlapping spans become one. n_chars, where there is one, follows. Clean rows stay as they are."""
    by_blob = if_small(scan(docs, [], ledger, rules).by_blob)  # texts stay where they are, unless very many blobs have findings

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        apart = F.struct(F.concat(acc["out"], gap, F.lit(replacement)).alias("out"), s["end"].alias("at"))
        return F.when(s["start"] >= acc["at"], apart).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at")))

    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    cut = F.aggregate(F.col("findings"), zero, step, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.lit(2**31 - 1))))
    out = address(docs).join(by_blob, "blob_id", "left").withColumn("__cut", F.when(F.col("findings").isNotNull(), cut))
    new = {"text": F.coalesce("__cut", "__row.text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("__cut").isNotNull(), F.length("__cut").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("__row.n_chars"))
    return out.select(*[(new[c] if c in new else F.col("__row").getField(c)).alias(c) for c in docs.columns])

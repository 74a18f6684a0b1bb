"""Secret scans over the history of a corpus, with a ledger of what has been scanned.

Every version of every path is addressed by the SHA-256 of its content, so copies, in whatever paths, are one blob. A rule
has a version. The ledger keeps the pairs of blob and rule version that have been scanned, and the findings; a new commit
scans only the pairs it lacks, and a report joins findings back to all paths that hold the blob. All of it is DataFrame
operations.

Findings are written before the pairs, and each in one job: a run that dies between the two only scans again what it had,
and the report counts a repeated finding once.

Defined cases: a null text is an empty one; a repeated row or path gives a line of its own in the report; a null path is
reported as such; an empty table gives an empty ledger; extra columns are not read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose group `group` has `least` characters or more, in the order of `rank` within a place."""

    kind: str
    rank: int
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


def either_case(words: str) -> str:
    """The pattern with each letter in either case, for the letters of ASCII only."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in words)


# The kinds that a report has to hold.
ASSIGN = "(" + either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (Rule("assign", 0, ASSIGN, 2, 8), Rule("access", 1, "AKIA[A-Z0-9]+", 0, 16), Rule("hex", 2, "[0-9a-f]{32,}", 0, 32))
# A run that is no token is passed over as a whole, with an empty group: what stands in it after its first `eyJ` has the same end,
# and would fail as well, so a long run is read once and not once for each `eyJ`.
JWT = r"(eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++)|eyJ[A-Za-z0-9_-]*+"

# The header, then all up to the footer, with no further header between; where there is no footer, lines of base64 with what may
# stand between them (quotes, marks of a quotation, escaped line ends), the armour's own headers and a short last line.
# Java runs the possessive groups in constant stack; RE2 takes the pattern without the possessive marks.
_HEAD, _TAIL = (f"-----{side} [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----" for side in ("BEGIN", "END"))
_FIELDS = r"(?:[\x20\t]*\r?\n[A-Za-z][A-Za-z0-9-]*:[^\n]*)*+"
_LINES = r"""(?:[\x20\t\r\n\\"'>#*|;,+]*[A-Za-z0-9+/=]{16,})++"""
_LAST = r"(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/]{1,15}={0,2}[\x20\t]*\r?(?m:$)|\\n[A-Za-z0-9+/]{1,15}={0,2})?"
PEM = f"{_HEAD}(?:[^-]*(?:-{{1,4}}[^-]+)*+{_TAIL}|{_FIELDS}{_LINES}{_LAST})?"
#: The first version of the rule `pem` found the header only; now the key itself is part of the finding.
HEADER = Rule("pem", 4, "-----BEGIN [A-Z ]*PRIVATE KEY-----")
RULES = (*BASE, Rule("jwt", 3, JWT, 1), Rule("pem", 4, PEM, version=2))
#: What is taken out of texts.
REDACTED = RULES


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def unseen(versions: DataFrame, rules: Sequence[Rule], pairs: DataFrame | None, text: str = "text") -> DataFrame:
    """One row for each blob that some rule has not scanned: blob, text, and those rules. The copies in a task are put
    together before the shuffle."""
    blobs = (versions.select(blob_id(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
             .groupBy("blob").agg(F.first("text").alias("text")))
    wanted = F.array(*(F.lit(r.id) for r in rules))
    if pairs is None:
        return blobs.withColumn("rules", wanted)
    seen = pairs.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    left = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "text", left.alias("rules")).filter(F.size("rules") > 0)


def scan(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The findings: blob, rule, kind, rank, start and end in code points.

    The text between matches and the matches themselves give the places: both come from the same pattern."""
    def found(rule: Rule) -> Column:
        pattern, text = F.lit(rule.pattern), F.col("text")
        hit = F.array_contains("rules", rule.id) & F.regexp_like(text, pattern)
        matches = F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
                               F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
                               F.split(text, rule.pattern, -1).alias("gap"))
        return F.when(hit, F.struct(F.lit(rule.id).alias("rule"), F.lit(rule.kind).alias("kind"), F.lit(rule.rank).alias("rank"),
                                    F.lit(rule.least).alias("least"), matches.alias("matches")))

    per_rule = blobs.select("blob", F.explode(F.array(*(found(r) for r in rules))).alias("f")).filter(F.col("f").isNotNull())
    each = (per_rule.select("blob", "f.rule", "f.kind", "f.rank", "f.least", F.posexplode("f.matches").alias("at", "m"))
            .select("blob", "rule", "kind", "rank", "least", "at", F.col("m.match").isNotNull().alias("is_match"),
                    F.length("m.gap").cast("long").alias("gap"), F.length("m.match").cast("long").alias("size"),
                    F.length("m.value").alias("value")))
    so_far = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return (each.withColumn("end", F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(so_far))
            .filter(F.col("is_match") & (F.col("value") >= F.col("least")))
            .select("blob", "rule", "kind", "rank", (F.col("end") - F.col("size")).alias("start"), "end"))


class Ledger:
    """A ledger in a folder that all executors reach; each commit adds a generation of files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def pairs(self) -> DataFrame:
        return self._read("pairs", "blob string, rules array<string>")

    def findings(self) -> DataFrame:
        """Without those that a run which died, and was run again, has left twice."""
        return self._read("findings", "blob string, rule string, kind string, rank int, start long, end long").dropDuplicates()

    def commit(self, versions: DataFrame, rules: Sequence[Rule], text: str = "text") -> None:
        known = self.pairs()
        known = None if known.isEmpty() else known
        scan(unseen(versions, rules, known, text), rules).write.mode("append").parquet(f"{self.folder}/findings")
        blobs = versions.select(blob_id(F.col(text)).alias("blob")).distinct()
        new = blobs.select("blob", F.array(*(F.lit(r.id) for r in rules)).alias("rules"))
        if known is not None:
            gained = F.array_except("rules", F.coalesce("seen", F.array().cast("array<string>")))
            seen = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
            new = new.join(seen, "blob", "left").select("blob", gained.alias("rules")).filter(F.size("rules") > 0)
        new.write.mode("append").parquet(f"{self.folder}/pairs")

    def report(self, versions: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
        """Each row of `versions` as the struct `row`, with its blob and `found`: the findings of the rules in order of place and
        rank, null where there are none. The findings of a blob are bounded by its text."""
        wanted = self.findings().filter(F.col("rule").isin([r.id for r in rules]))
        per_blob = wanted.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("found"))
        return versions.select(F.struct("*").alias("row"), blob_id(F.col(text)).alias("blob")).join(per_blob, "blob", "left")


def redacted(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """The text with each finding replaced; overlapping ones together by one mark. Null where the text is."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def cut(done: Column, f: Column) -> Column:
        gap = F.substring(text, (done["at"] + 1).cast("int"), (f["start"] - done["at"]).cast("int"))
        return F.struct(F.greatest(done["at"], f["end"]).alias("at"),
                        F.when(f["start"] >= done["at"], F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"]).alias("out"))

    def rest(done: Column) -> Column:
        return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))
    return F.when(found.isNull(), text).otherwise(F.aggregate(found, start, cut, rest))


def spans(found: Column) -> Column:
    """kind:start:end of each finding, joined by commas."""
    empty = F.array().cast("array<string>")
    return F.array_join(F.coalesce(F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), empty), ",")


def of_kinds(found: Column, kinds: Sequence[str]) -> Column:
    return F.filter(found, lambda f: f["kind"].isin(list(kinds)))


def count(found: Column, kind: str) -> Column:
    return F.coalesce(F.size(of_kinds(found, [kind])), F.lit(0)).cast("long")

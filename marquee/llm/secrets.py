"""Secret scans with multipart credential linking, in DataFrame functions only.

Base findings (reported always; leftmost, non-overlapping for each kind):
``assign`` a value of 8 or more characters given to a password-like name,
``access`` an access key id, ``hex`` 32 or more hexadecimal digits.

Weak candidates tell nothing alone: ``weak_id`` (a user or client id, a short
access key id), ``weak_secret`` (40 base64 characters of mixed kinds) and
``endpoint`` (a URL or host setting).  They are linked by an interval join:
positions are cut into cells of ``SCOPE`` code points, each cell keeps the
first and last place of identifiers, secrets and endpoints, and a candidate is
joined to its own and the two neighbouring cells.  An identifier is reported
when a secret stands within ``SCOPE`` of it, a secret when an identifier does,
an endpoint when both do; base findings count as parts.  A candidate that
overlaps a base finding is not reported.  No pairs are emitted, so a text full
of candidates costs a row for each.

Places come from the matches' and gaps' lengths, summed in order.  Texts with
findings are handled once for all their copies (keyed by their digest).

Cases: a null text is scanned as an empty one and has no findings; ties are
ordered by start, then kind as listed, then end; repeated rows are each
answered; other columns are kept (``findings`` is replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
LEAST_VALUE = 8
#: Runs too short to count are left out by the pattern: a shorter tail of the same run can't count either.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
WEAK_ID = (r"(?i:(?:access|client|account|user)[_-]?(?:key[_-]?)?(?:id|name)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{4,})"
           r"|(?<![A-Z0-9])(?:AKIA|ASIA)[A-Z0-9]{4,}")
WEAK_SECRET = (r"(?<![A-Za-z0-9+/=_.-])(?=[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=]))(?=[a-z+/A-Z]*[0-9])"
               r"(?=[a-z+/0-9]*[A-Z])(?=[A-Z+/0-9]*[a-z])[A-Za-z0-9+/]{40}")
ENDPOINT = (r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[^\x00-\x20\"'<>]*)?"
            r"|(?i:(?:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]{4,})")
#: In order of their listing: pattern, group whose length counts, least length, base or not, part.
KINDS = {
    "assign": (ASSIGN, 2, LEAST_VALUE, True, "secret"),
    "access": (ACCESS, 0, 16, True, "id"),
    "hex": (HEX, 0, 32, True, "secret"),
    "weak_id": (WEAK_ID, 0, 1, False, "id"),
    "weak_secret": (WEAK_SECRET, 0, 40, False, "secret"),
    "endpoint": (ENDPOINT, 0, 1, False, "endpoint"),
}
SCOPE = 400
FINDINGS = "array<struct<start:int,kind_no:int,end:int,kind:string,base:boolean>>"


def _may_hold(text: Column) -> Column:
    """Whether a text can have a finding: a base one, or both parts of a weak one."""
    return (text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX)
            | (text.rlike(WEAK_ID) & text.rlike(WEAK_SECRET)))


def _matches(text: Column, number: int, pattern: str, group: int) -> Column:
    """Rows in order: kind number, length of the gap before, of the match and of its group."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    length = lambda xs: F.transform(xs, lambda x: F.length(x))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    return F.transform(
        F.arrays_zip(length(gaps).alias("gap"), length(whole).alias("size"), length(value).alias("value")),
        lambda m: F.struct(F.lit(number).alias("kind_no"), m["gap"].alias("gap"), m["size"].alias("size"),
                           m["value"].alias("value")))


def _spans(held: DataFrame) -> DataFrame:
    """``digest, findings`` for the texts of ``held`` (columns digest, text)."""
    specs = list(KINDS.values())
    once = held.dropDuplicates(["digest"])
    rows = written(once.select("digest", F.posexplode(F.concat(*[
        _matches(F.col("text"), k, s[0], s[1]) for k, s in enumerate(specs)])).alias("at", "m")).select("digest", "at", "m.*"))
    upto = Window.partitionBy("digest", "kind_no").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(upto).cast("int")
    kind = F.array(*[F.lit(k) for k in KINDS])
    least = F.array(*[F.lit(s[2]) for s in specs])
    base = F.array(*[F.lit(s[3]) for s in specs])
    part = F.array(*[F.lit(s[4]) for s in specs])
    pick = lambda xs: F.element_at(xs, F.col("kind_no") + 1)
    found = (rows.withColumn("end", end).filter(F.col("value") >= pick(least))
             .select("digest", (F.col("end") - F.col("size")).cast("int").alias("start"), "kind_no", "end",
                     pick(kind).alias("kind"), pick(base).alias("base"), pick(part).alias("part")))
    # A candidate overlaps a base finding that starts at or before it, or one that starts before it ends.
    forward = Window.partitionBy("digest").orderBy("start", "kind_no").rowsBetween(Window.unboundedPreceding, -1)
    backward = (Window.partitionBy("digest").orderBy(F.desc("start"), F.desc("kind_no"))
                .rowsBetween(Window.unboundedPreceding, -1))
    before = F.max(F.when(F.col("base"), F.col("end"))).over(forward)
    after = F.min(F.when(F.col("base"), F.col("start"))).over(backward)
    found = (found.withColumn("before", before).withColumn("after", after)
             .filter(F.col("base") | ~F.coalesce((F.col("before") > F.col("start")) | (F.col("after") < F.col("end")),
                                                 F.lit(False)))
             .withColumn("cell", F.floor(F.col("start") / SCOPE)).drop("before", "after"))
    found = written(found)
    places = [f(F.when(F.col("part") == p, F.col("start"))).alias(f"{n}_{p}")
              for p in ("id", "secret", "endpoint") for n, f in (("first", F.min), ("last", F.max))]
    cells = written(found.groupBy("digest", "cell").agg(*places))
    near = found.filter(~F.col("base")).withColumn("other", F.explode(F.array(*[F.col("cell") + d for d in (-1, 0, 1)])))

    def within(p: str) -> Column:
        start, cell, other = F.col("start"), F.col("cell"), F.col("other")
        return F.max(F.coalesce(
            F.when(other == cell, F.col(f"first_{p}").isNotNull())
            .when(other < cell, F.col(f"last_{p}") >= start - SCOPE)
            .otherwise(F.col(f"first_{p}") <= start + SCOPE), F.lit(False))).alias(f"near_{p}")

    linked = (near.join(cells.withColumnRenamed("cell", "other"), ["digest", "other"])
              .groupBy("digest", "start", "kind_no", "end", "kind", "base", "part").agg(within("id"), within("secret"))
              .filter(F.when(F.col("part") == "id", F.col("near_secret")).when(F.col("part") == "secret", F.col("near_id"))
                      .otherwise(F.col("near_id") & F.col("near_secret"))))
    columns = ["start", "kind_no", "end", "kind", "base"]
    every = found.filter("base").select("digest", *columns).union(linked.select("digest", *columns))
    return every.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("findings"))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``findings``: structs of start, kind_no, end (code points, end exclusive), kind and base, in order."""
    docs = docs.drop("findings")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    may = _may_hold(F.coalesce(F.col(text), F.lit("")))
    held = written(docs.filter(may).withColumn("__digest", F.sha1(text)))
    spans = written(_spans(held.select(F.col("__digest").alias("digest"), F.col(text).alias("text"))))
    none = F.expr(f"cast(array() as {FINDINGS})")
    with_spans = held.join(spans.withColumnRenamed("digest", "__digest"), "__digest", "left").select(
        *columns, F.coalesce(F.col("findings").cast(FINDINGS), none).alias("findings"))
    return docs.filter(~may).select(*columns, none.alias("findings")).union(with_spans)


def described(findings: Column) -> Column:
    """``kind:start:end`` of the findings, comma-joined."""
    return F.concat_ws(",", F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"),
                                                                        f["end"].cast("string"))))


def redact(text: Column, findings: Column, mark: str = "[SECRET]") -> Column:
    """The text with every finding (or run of overlapping ones) replaced by ``mark``."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(s, f):
        put = F.concat(s["out"], F.substr(text, s["at"] + 1, f["start"] - s["at"]), F.lit(mark))
        return F.struct(F.when(f["start"] >= s["at"], put).otherwise(s["out"]).alias("out"),
                        F.greatest(s["at"], f["end"]).alias("at"))

    return F.when(F.size(findings) == 0, text).otherwise(F.aggregate(
        findings, state, step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1))))

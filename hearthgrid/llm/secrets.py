"""Secret scans: base patterns and multipart credentials.

Base kinds (assign, access, hex) are reported wherever they stand. Weak parts (ident: an account or client id; opaque: a
long token of letters and digits; endpoint: a URL) say nothing alone. Parts are interval-joined: two are linked if they
stand in one scope (text without a blank line) and do not overlap; with a `window`, at most so many code points apart.
An ident is reported if it is linked to a secret, an opaque token if it is linked to an identifier (access or ident) or
to an endpoint that has one, an endpoint if it is linked to an identifier and to a secret. What a base span overlaps is
no weak part, nor is an opaque token that an endpoint overlaps.

Without a window the join is a sweep over the sorted ends of all parts of a scope: how many parts of a role have ended
before a part starts, and how many start only after it ends, are running counts, so no pair is made.

Defined results: a null text is an empty one and has no spans; equal rows give equal rows; documents of any length are
scanned whole; a table without rows gives none; other columns are left alone.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

# The base patterns and the least lengths of their matches (of the value for assign).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: A quick test that any match of the kind meets.
HEX_LIKE, ACCESS_LIKE = r"[0-9a-f]{24}", r"AKIA[A-Z0-9]{16}"
IDENT = r"""(?i)\b(?:account|client|tenant|user|access_key)_?id["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)"""
OPAQUE = r"[A-Za-z0-9+/_=-]{16,}"
ENDPOINT = r"""\b(?:https?|wss?|ftp|ssh|s3|amqps?|postgres(?:ql)?|mysql|mongodb|redis)://[^\s"'<>]+"""
BLANK = r"\n[\x20\x09\r]*\n"
KINDS = ("assign", "access", "hex", "ident", "opaque", "endpoint")
#: Code points between the parts of a candidate that the pipeline takes out.
NEAR = 256
#: Matches whose lengths are added up at a time.
CHUNK = 128
_SPANS = "array<struct<start:bigint,end:bigint>>"


def matches(text: Column, like: str, pattern: str, group: int, least: int, also: str | None = None) -> Column:
    """Spans (code points, end exclusive) of the leftmost matches that do not overlap, if `group` has `least` characters
    and the match fits `also`.

    The text between the matches tells where they are, as no function gives all positions. Lengths are added up in
    chunks of CHUNK matches, from the sums of the chunks before, so the work grows with the text and the matches.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = hits if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("bigint"))
    found = F.transform(
        F.arrays_zip(hits.alias("hit"), values.alias("value")),
        lambda m: F.struct(F.length(m["hit"]).cast("bigint").alias("long"), ((F.length(m["value"]) >= least) & (m["hit"].rlike(also) if also else F.lit(True))).alias("good")),
    )
    parts = F.arrays_zip(gaps.alias("gap"), found.alias("hit"))  # one gap more than hits
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(acc, part):
        start = acc["at"] + part["gap"]
        end = start + F.coalesce(part["hit"]["long"], F.lit(0))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(part["hit"]["good"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    def within(chunk):
        # positions relative to the chunk
        return F.aggregate(chunk, zero, step)

    def placed(acc, chunk):
        return F.struct(
            (acc["at"] + chunk["at"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")
        )

    def spread(chunks):
        none = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("starts"))
        starts = F.aggregate(chunks, none, placed, lambda acc: acc["starts"])
        moved = F.transform(
            F.arrays_zip(chunks.alias("chunk"), starts.alias("start")),
            lambda c: F.transform(c["chunk"]["spans"], lambda s: F.struct((s["start"] + c["start"]).alias("start"), (s["end"] + c["start"]).alias("end"))),
        )
        return F.flatten(moved)

    def cut(parts):
        firsts = F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1)), F.lit(CHUNK))
        return F.transform(firsts, lambda first: within(F.slice(parts, first, CHUNK)))

    return F.when(text.rlike(like), once(parts, lambda p: once(cut(p), spread))).otherwise(F.array().cast(_SPANS))


def once(value: Column, function) -> Column:
    """function(value), where value is computed a single time however often the function names it."""
    return F.element_at(F.transform(F.array(value), function), 1)


def _tagged(column: str, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.transform(column, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("number"), s["end"].alias("end")))


def listed(spans: Column) -> Column:
    """kind:start:end of sorted spans, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    shown = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["number"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")


def scan(docs: DataFrame) -> DataFrame:
    """Per document its doc_id, a content key, base spans and weak parts with their scopes."""
    text = F.coalesce("text", F.lit(""))
    has_url = F.contains(text, F.lit("://"))
    base = docs.select(
        "doc_id",
        text.alias("text"),
        F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(text)).alias("key"),
        matches(text, ASSIGN, ASSIGN, 2, 6).alias("assign"),
        matches(text, ACCESS_LIKE, ACCESS, 0, 20).alias("access"),
        matches(text, HEX_LIKE, HEX, 0, 24).alias("hex"),
        matches(text, IDENT, IDENT, 1, 1).alias("ident"),
        F.when(has_url, matches(text, ENDPOINT, ENDPOINT, 0, 1)).otherwise(F.array().cast(_SPANS)).alias("endpoint"),
    )
    text = F.col("text")
    anchored = (F.size("access") > 0) | (F.size("ident") > 0) | (F.size("endpoint") > 0)
    opaque = F.when(anchored, matches(text, OPAQUE, OPAQUE, 0, 1, r"(?=.*[0-9])(?=.*[A-Za-z])")).otherwise(F.array().cast(_SPANS))
    cuts = F.when(anchored, matches(text, BLANK, BLANK, 0, 1)).otherwise(F.array().cast(_SPANS))
    return base.select("doc_id", "key", "assign", "access", "hex", "ident", "endpoint", opaque.alias("opaque"), cuts.alias("cuts"))


def _parts(scanned: DataFrame) -> DataFrame:
    """(key, scope, start, end, number, role) of all parts of documents that have an anchor."""
    # blank lines stand between the parts, as a seventh kind: their number up to a part is its scope
    lines = F.transform("cuts", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("number"), s["end"].alias("end")))
    every = F.concat(*[_tagged(k, k) for k in KINDS], lines)
    before = Window.partitionBy("key").orderBy("p.start", "p.number", "p.end").rowsBetween(Window.unboundedPreceding, 0)
    parts = (
        scanned.filter((F.size("access") > 0) | (F.size("ident") > 0) | (F.size("endpoint") > 0))
        .select("key", F.explode(every).alias("p"))
        .distinct()
        .withColumn("scope", F.count_if(F.col("p.number") == len(KINDS)).over(before))
        .filter(F.col("p.number") < len(KINDS))
        .select(
            "key",
            "scope",
            "p.start",
            "p.end",
            "p.number",
            # an access or ident identifies, an assign, hex or opaque is a secret
            F.when(F.col("p.number").isin(1, 3), "who").when(F.col("p.number") == 5, "where").otherwise("what").alias("role"),
        )
    )
    return parts


def _counts() -> Column:
    return (
        ((F.col("number") == 3) & F.col("what"))
        | ((F.col("number") == 4) & F.col("who"))
        | ((F.col("number") == 5) & F.col("who") & F.col("what"))
    )


def _swept(parts: DataFrame) -> DataFrame:
    """(key, start, end, number) of the weak parts that their scope supports."""
    events = parts.withColumn("e", F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(True).alias("opens")), F.struct(F.col("end").alias("at"), F.lit(False).alias("opens")))))
    # at one place parts end before others start
    so_far = Window.partitionBy("key", "scope").orderBy("e.at", "e.opens")
    scope = Window.partitionBy("key", "scope")
    groups = {"who": F.col("role") == "who", "what": F.col("role") == "what", "base": F.col("number") < 3, "url": F.col("number") == 5}
    counts = {f"n_{g}": F.count_if(rule & F.col("e.opens")).over(scope) for g, rule in groups.items()}
    counts |= {f"opened_{g}": F.count_if(rule & F.col("e.opens")).over(so_far) for g, rule in groups.items()}
    counts |= {f"ended_{g}": F.count_if(rule & ~F.col("e.opens")).over(so_far) for g, rule in groups.items()}
    swept = events.withColumns(counts).filter("number > 2").groupBy("key", "scope", "start", "end", "number")
    opens = lambda c: F.max(F.when(F.col("e.opens"), F.col(c)))
    closes = lambda c: F.max(F.when(~F.col("e.opens"), F.col(c)))
    # ended up to the start of a part, and opened before its end
    apart = {g: (opens(f"ended_{g}") + opens(f"n_{g}") - closes(f"opened_{g}") > 0).alias(g) for g in ("who", "what")}
    over = {g: (closes(f"opened_{g}") - opens(f"ended_{g}") > 0).alias(f"on_{g}") for g in ("base", "url")}
    rated = swept.agg(*apart.values(), *over.values())
    return rated.filter(~F.col("on_base") & ~((F.col("number") == 4) & F.col("on_url")) & _counts())


def linked(scanned: DataFrame, window: int | None = None) -> DataFrame:
    """Weak spans that complementary parts support: (key, weak spans)."""
    parts = _parts(scanned)
    supported = _swept(parts) if window is None else _joined(parts, window)
    return supported.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "number", "end"))).alias("weak"))


def _joined(parts: DataFrame, window: int) -> DataFrame:
    """(key, start, end, number) of the weak parts that parts within the window support."""
    # what a base span covers is no weak part. Each part stands in all slots up to the window behind its end, so whatever lies
    # within the gap or overlaps meets in the slot of the later start, whatever its length
    slot = lambda c: F.floor(F.col(c) / window)
    parts = parts.withColumn("slot", F.explode(F.sequence(slot("start"), F.floor((F.col("end") + window) / window))))
    other = parts.select(
        "key", "scope", F.col("start").alias("o_start"), F.col("end").alias("o_end"), F.col("number").alias("o_number"), F.col("role").alias("o_role"), "slot"
    )
    meets = F.col("slot") == F.greatest(slot("start"), slot("o_start"))
    overlap = (F.col("o_start") < F.col("end")) & (F.col("start") < F.col("o_end"))
    gap = F.greatest(F.col("o_start") - F.col("end"), F.col("start") - F.col("o_end"))
    joined = parts.filter("number > 2").join(other, ["key", "scope", "slot"]).filter(meets & (gap <= window))
    apart = ~overlap & (F.col("number") == 4) & (F.col("o_number") == 5)
    support = joined.groupBy("key", "start", "end", "number", "role").agg(
        F.collect_set(F.when(apart, F.col("o_start"))).alias("ends"),
        F.max(overlap & ((F.col("o_number") < 3) | (F.col("o_number") > F.col("number")) & (F.col("number") == 4))).alias("covered"),
        *[F.max(~overlap & (F.col("o_role") == r)).alias(r) for r in ("who", "what")],
    )
    # second hop: opaque tokens linked to an endpoint that an identifier is linked to. Endpoints don't overlap, their start names them
    support = common.keep(support, "support")
    known = support.filter((F.col("number") == 5) & F.col("who")).select("key", F.col("start").alias("where_start"))
    hops = support.select("key", "start", "end", "number", F.explode("ends").alias("where_start")).join(known, ["key", "where_start"])
    hops = hops.select("key", "start", "end", "number", F.lit(True).alias("hop")).distinct()
    support = support.join(hops, ["key", "start", "end", "number"], "left")
    return support.withColumn("who", F.col("who") | F.coalesce("hop", F.lit(False))).filter(~F.col("covered") & _counts())


def find(docs: DataFrame, window: int | None = None) -> DataFrame:
    """Per document: doc_id, key, base and all spans, sorted by start and kind."""
    scanned = common.keep(scan(docs), "secrets")
    base = F.array_sort(F.concat(*[_tagged(k, k) for k in KINDS[:3]]))
    weak = F.coalesce("weak", F.array().cast("array<struct<start:bigint,number:int,end:bigint>>"))
    return (
        scanned.join(linked(scanned, window), "key", "left")
        .withColumns({"base": base, "n_linked": F.size(weak).cast("long")})
        .withColumn("all", F.array_sort(F.concat("base", weak)))
        .select("doc_id", "key", "assign", "access", "hex", "base", "all", "n_linked")
    )


def digest(docs: DataFrame, window: int | None = None) -> DataFrame:
    return find(docs, window).select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("all")).alias("spans"),
        "n_linked",
    )


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with its spans replaced; spans that overlap become one."""
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        lead = F.substr(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))
        apart = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(apart, F.concat(acc["out"], F.array(lead, F.lit(mark)))).otherwise(acc["out"]).alias("out"),
        )

    tail = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(text, acc["at"].cast("int") + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, zero, step, tail)).otherwise(text)


@common.apart
def stage(docs: DataFrame) -> DataFrame:
    """Pipeline stage: secrets are taken out of the texts, all documents stay.

    Weak candidates are taken out where their parts stand within NEAR code points, so text that merely shares a long
    scope stays as it is.
    """
    columns = docs.columns
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit(""))))
    spans = find(docs, NEAR).filter(F.size("all") > 0).select(F.col("key").alias("_key"), F.col("all").alias("_spans")).dropDuplicates(["_key"])
    out = docs.withColumn("_key", key).join(spans, "_key", "left")
    out = out.withColumn("text", F.when(F.col("_spans").isNotNull(), redact(F.col("text"), F.col("_spans"))).otherwise(F.col("text")))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("_spans").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*columns)

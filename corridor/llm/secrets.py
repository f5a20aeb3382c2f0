"""Secret scans with DataFrame functions only: fixed patterns and windowed entropy.

The patterns give the base spans. Besides, strings of token characters are searched for
windows of high Shannon entropy, for each character class by its own alphabet, length
and threshold: counts of the characters in the window and the sum of n*log2(n) over them
move along with the window (one character in, one out), scaled to integers so that no
rounding decides. Windows above the threshold are joined to one span per string. Strings
of an allow-listed shape, and those inside a base span, are left out.

Positions are code points, ends exclusive. Null texts count as empty; texts without
secrets give zero counts and empty lists; very long texts are scanned whole; equal rows
give equal rows; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCALE = 1_000_000


@dataclass(frozen=True)
class Pattern:
    """A kind of base span: matches of ``regex``; ``group`` needs ``least`` characters."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    #: A cheaper test that every text with a match passes.
    sign: str = ""


@dataclass(frozen=True)
class EntropyClass:
    """Strings over ``alphabet`` whose windows are measured against ``bits`` per character."""

    kind: str
    alphabet: str
    chars: str
    window: int
    bits: float
    #: What a string must contain to be looked at.
    needs: tuple[str, ...]

    @property
    def regex(self) -> str:
        return rf"(?<![{self.chars}])[{self.chars}]{{{self.window},}}+"

    @property
    def table(self) -> list[int]:
        """n*log2(n), scaled, for n characters of a kind in the window."""
        return [0, *(round(_SCALE * n * log2(n)) for n in range(1, self.window + 2))]

    @property
    def most(self) -> int:
        """Largest scaled sum of n*log2(n) that still has ``bits`` of entropy."""
        return round(_SCALE * self.window * (log2(self.window) - self.bits))


_KEY = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"

PATTERNS = (
    Pattern(
        "assign",
        rf"""(?:{_KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=1,
        least=6,
        sign=rf"(?:{_KEY})[\"'\x20:=]",
    ),
    Pattern("access", r"AKIA[A-Z0-9]{16,}", sign="AKIA"),
    Pattern("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+"),
)

ENTROPY = (
    EntropyClass(
        "entropy_hex",
        "0123456789abcdefABCDEF",
        "0-9a-fA-F",
        20,
        3.0,
        ("[0-9]", "[a-fA-F]"),
    ),
    EntropyClass(
        "entropy_base64",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
        "A-Za-z0-9+/_-",
        20,
        3.8,
        ("[0-9]", "[a-z]", "[A-Z]"),
    ),
)

#: Shapes of strings that are long and varied, but no secrets.
ALLOWED = (
    "^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",  # identifiers
    "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]",  # times
    "(?i)abcdefghij|0123456789|example|placeholder|dummy",
    "^/?(?:[A-Za-z]+[0-9]?/)+[A-Za-z]*[0-9]?$",  # paths of words
    "^(?:[A-Z]?[a-z]+[-_])+[A-Z]?[a-z]*[0-9]{0,4}$",  # words joined by dashes
)

#: Windows of a string whose counts are carried from one to the next.
BLOCK = 64
_SPAN = "array<struct<kind:string,start:int,end:int>>"


def _matches(text: Column, regex: str, group: int) -> Column:
    """Structs (start, end, value) of all matches, in order.

    The text falls into gaps and matches, one more gap than matches; their lengths add
    up to the positions.
    """
    whole = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(regex), F.lit(group))
    gaps = F.split(text, regex, -1)
    found = F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("whole"), value.alias("value"))
    start = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,end:int,value:string>>").alias("done"),
    )

    def add(state: Column, m: Column) -> Column:
        begin = state["at"] + F.length(m["gap"])
        end = begin + F.length(m["whole"])
        one = F.struct(begin.alias("start"), end.alias("end"), m["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["done"], F.array(one)).alias("done"))

    return F.aggregate(found, start, add, lambda state: state["done"])


def _none() -> Column:
    return F.array().cast(_SPAN)


def base_spans(text: Column, pattern: Pattern) -> Column:
    """Spans of one pattern that are long enough."""
    enough = F.filter(
        _matches(text, pattern.regex, pattern.group),
        lambda m: F.length(m["value"]) >= pattern.least,
    )
    spans = F.transform(
        enough,
        lambda m: F.struct(
            F.lit(pattern.kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")
        ),
    )
    return F.when(text.rlike(pattern.sign or pattern.regex), spans).otherwise(_none())


def hot_windows(value: Column, cls: EntropyClass) -> Column:
    """Starts (from 1) of the windows of ``value`` with enough entropy, in order.

    A long string is worked on in blocks of ``BLOCK`` windows. What one step of the counts
    costs grows with the string it walks, so blocks keep the whole in proportion.
    """
    starts = F.sequence(F.lit(0), F.length(value) - cls.window, F.lit(BLOCK))
    # The parts are cut out first: what a function refers to is computed at every use.
    blocks = F.transform(
        starts,
        lambda before: F.struct(
            before.alias("before"),
            F.substring(value, before + 1, F.lit(BLOCK + cls.window - 1)).alias("part"),
        ),
    )
    hot = F.transform(
        blocks,
        lambda b: F.transform(_hot_in_block(b["part"], cls), lambda start: start + b["before"]),
    )
    return F.when(F.length(value) >= cls.window, F.flatten(hot)).otherwise(
        F.array().cast("array<int>")
    )


def _hot_in_block(value: Column, cls: EntropyClass) -> Column:
    f = F.array(*map(F.lit, cls.table))
    size, letters = cls.window, len(cls.alphabet)

    def at(i: Column) -> Column:
        return F.position(F.substring(value, i, F.lit(1)), F.lit(cls.alphabet))

    def step(counts: Column, letter: Column, by: int) -> Column:
        return F.transform(counts, lambda n, k: n + F.when(k + 1 == letter, by).otherwise(0))

    def table(n: Column) -> Column:
        return F.element_at(f, n + 1)

    def slide(state: Column, i: Column) -> Column:
        came = at(i)
        n_in = F.element_at(state["counts"], came)
        counts = step(state["counts"], came, 1)
        total = state["total"] + table(n_in + 1) - table(n_in)
        went = at(i - size)
        n_out = F.element_at(counts, went)
        full = i > size
        total = F.when(full, total - table(n_out) + table(n_out - 1)).otherwise(total)
        counts = F.when(full, step(counts, went, -1)).otherwise(counts)
        return F.struct(
            counts.alias("counts"),
            total.alias("total"),
            F.when(
                (i >= size) & (total <= cls.most),
                F.concat(state["hot"], F.array((i - size + 1).cast("int"))),
            )
            .otherwise(state["hot"])
            .alias("hot"),
        )

    start = F.struct(
        F.array_repeat(F.lit(0), letters).alias("counts"),
        F.lit(0).cast("int").alias("total"),
        F.array().cast("array<int>").alias("hot"),
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.length(value)), start, slide, lambda state: state["hot"]
    )


def entropy_spans(text: Column, base: Column, cls: EntropyClass) -> Column:
    """One span for each string of the class with hot windows, outside ``base``."""

    def looked_at(m: Column) -> Column:
        value = m["value"]
        tests = [value.rlike(need) for need in cls.needs]
        tests += [~value.rlike(shape) for shape in ALLOWED]
        tests.append(
            ~F.exists(base, lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"]))
        )
        return reduce(lambda a, b: a & b, tests)

    strings = F.filter(_matches(text, cls.regex, 0), looked_at)
    measured = F.transform(
        strings,
        lambda m: F.struct(
            m["start"].alias("start"), hot_windows(m["value"], cls).alias("hot")
        ),
    )
    spans = F.transform(
        F.filter(measured, lambda m: F.size(m["hot"]) > 0),
        lambda m: F.struct(
            F.lit(cls.kind).alias("kind"),
            (m["start"] + F.element_at(m["hot"], 1) - 1).alias("start"),
            (m["start"] + F.element_at(m["hot"], -1) - 1 + cls.window).alias("end"),
        ),
    )
    # A string that has what it needs lies between two other characters.
    return F.when(text.rlike(cls.regex), spans).otherwise(_none())


def _listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed."""
    order = [p.kind for p in PATTERNS] + [c.kind for c in ENTROPY]
    kinds = F.array(*map(F.lit, order))
    ranked = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"], F.array_position(kinds, s["kind"]).alias("rank"), s["kind"], s["end"]
            ),
        )
    )
    return F.array_join(
        F.transform(
            ranked,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def find_secrets(docs: DataFrame, base: str = "base", added: str = "added") -> DataFrame:
    """``docs`` with two more array columns of spans (kind, start, end), under free names."""
    text = F.coalesce(F.col("text"), F.lit(""))
    for name in (base, added):
        if name.lower() in (c.lower() for c in docs.columns):
            raise ValueError(f"the documents have a column {name!r} of their own")
    found = docs.withColumn(base, F.concat(*(base_spans(text, p) for p in PATTERNS)))
    return found.withColumn(
        added, F.concat(*(entropy_spans(text, F.col(base), c) for c in ENTROPY))
    )


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per document: base spans by kind, their digest and the list of all spans."""

    def n(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return find_secrets(docs.select(F.col("doc_id"), F.col("text"))).select(
        "doc_id",
        *(n(p.kind).alias(f"n_{p.kind}") for p in PATTERNS),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
    )


def mask_secrets(docs: DataFrame, mask: str = "<secret>") -> DataFrame:
    """Documents with every span replaced; overlapping spans share one mask.

    All columns stay, whatever their names.
    """
    base, added = _free(docs, "base"), _free(docs, "added")
    spans = F.array_sort(
        F.transform(
            F.concat(base, added), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
        )
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def cut(state: Column, s: Column) -> Column:
        kept = F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"])
        fresh = F.concat(state["done"], kept, F.lit(mask))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["start"] < state["at"], state["done"]).otherwise(fresh).alias("done"),
        )

    masked = F.aggregate(
        spans,
        start,
        cut,
        lambda state: F.concat(state["done"], F.substring(F.col("text"), state["at"] + 1, F.length("text"))),
    )
    changed = F.when(F.size(spans) > 0, masked).otherwise(F.col("text"))
    return find_secrets(docs, base, added).withColumn("text", changed).select(*docs.columns)


def oracle() -> str:
    """DuckDB SQL for ``scan_secrets``: spans from gaps, windows counted one by one."""

    def found(name: str, regex: str, group: int) -> str:
        quoted = regex.replace("'", "''")
        return (
            f"{name} AS (SELECT r, i, g, m, v FROM (SELECT r, generate_subscripts(m, 1) AS i, g, m, v FROM"
            f" (SELECT r, regexp_split_to_array(text, '{quoted}') AS g,"
            f" regexp_extract_all(text, '{quoted}') AS m,"
            f" regexp_extract_all(text, '{quoted}', {group}) AS v FROM d)))"
        )

    def placed(name: str) -> str:
        lengths = "coalesce(list_sum([length(x) for x in {}]), 0)"
        return (
            f"{lengths.format('g[1:i]')}::INT + {lengths.format('m[1:i - 1]')}::INT AS s,"
            f" length(m[i]) AS n, v[i] AS value FROM {name}"
        )

    parts, spans = [], []
    for rank, p in enumerate(PATTERNS):
        regex = p.regex.replace("(?<![0-9a-f])", "").replace("}+", "}")
        parts.append(found(f"m{rank}", regex, p.group))
        spans.append(
            f"SELECT r, {rank} AS rank, '{p.kind}' AS kind, s, s + n AS e FROM"
            f" (SELECT r, {placed(f'm{rank}')}) WHERE length(value) >= {p.least}"
        )
    parts.append("base AS (" + " UNION ALL ".join(spans) + ")")
    added = []
    for rank, c in enumerate(ENTROPY, len(PATTERNS)):
        parts.append(found(f"m{rank}", f"[{c.chars}]{{{c.window},}}", 0))
        needs = " AND ".join(f"regexp_matches(value, '{need}')" for need in c.needs)
        allowed = " AND ".join(f"NOT regexp_matches(value, '{shape}')" for shape in ALLOWED)
        table = ", ".join(map(str, c.table))
        parts.append(
            f"c{rank} AS (SELECT * FROM (SELECT r, {placed(f'm{rank}')}) AS c WHERE {needs} AND {allowed}"
            f" AND NOT EXISTS (SELECT 1 FROM base WHERE base.r = c.r AND base.s <= c.s AND c.s + c.n <= base.e))"
        )
        parts.append(
            f"w{rank} AS (SELECT r, s, pos, sum(([{table}])[k + 1]) AS total FROM (SELECT r, s, pos, letter, count(*) AS k"
            f" FROM (SELECT r, s, pos, unnest(string_split(value[pos:pos + {c.window - 1}], '')) AS letter FROM"
            f" (SELECT r, s, value, unnest(range(1, n - {c.window - 2})) AS pos FROM c{rank})) GROUP BY ALL) GROUP BY ALL)"
        )
        added.append(
            f"SELECT r, {rank} AS rank, '{c.kind}' AS kind, s + min(pos) - 1 AS s, s + max(pos) - 1 + {c.window} AS e"
            f" FROM w{rank} WHERE total <= {c.most} GROUP BY r, s"
        )
    parts.append("added AS (" + " UNION ALL ".join(added) + ")")
    listed = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank)"
    counts = ", ".join(
        f"count(*) FILTER (WHERE kind = '{p.kind}') AS n_{p.kind}" for p in PATTERNS
    )
    return (
        "WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents), "
        + ", ".join(parts)
        + f", b AS (SELECT r, {counts}, {listed} AS listed FROM base GROUP BY r)"
        + f", a AS (SELECT r, {listed} AS listed FROM (FROM base UNION ALL FROM added) GROUP BY r)"
        + " SELECT doc_id, "
        + ", ".join(f"coalesce(n_{p.kind}, 0) AS n_{p.kind}" for p in PATTERNS)
        + ", sha256(coalesce(b.listed, '')) AS base_sha256, coalesce(a.listed, '') AS spans"
        " FROM d LEFT JOIN b USING (r) LEFT JOIN a USING (r)"
    )

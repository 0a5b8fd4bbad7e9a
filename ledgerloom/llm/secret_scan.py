"""Secret scan: fixed patterns, and windows of high entropy in candidate strings.

All of it is DataFrame expressions; every text is scanned whole, in place.

Base kinds (leftmost, non-overlapping matches; too short ones go):
``assign``, a keyword with an assigned value; ``access``, an access key id;
``hex``, a long run of hexadecimal digits.

The method adds kind ``entropy``.  Candidates are runs of at least ``WINDOW``
characters of the widest class that hold a digit and a letter.  A candidate's
class is the narrowest that has all its characters.  A window of ``WINDOW``
characters slides over it; the counts of the class's characters change by the
one that enters and the one that leaves, and with them the sum of c * log2(c),
which gives the window's Shannon entropy.  The windows that reach the class's
threshold make one span, from the start of the first to the end of the last.
Candidates that an allow-list pattern matches, or that follow an allowed
prefix, are suppressed, and so are spans inside a base span.

Offsets are code points, the end exclusive.  Null texts are empty texts, and
those have no spans.  Rows are independent: repeated rows give equal results,
extra columns pass through or are not read, an empty table gives an empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.quality import let

#: Fixed values of the base kinds: name, guard, pattern, group that must be long, its least length.
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
     r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16}", r"(AKIA[A-Z0-9]+)", 1, 20),
    ("hex", r"[0-9a-f]{24}", r"([0-9a-f]+)", 1, 24),
)
KINDS = (*(b[0] for b in BASE), "entropy")

#: Characters of a window.
WINDOW = 20
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "0123456789"
#: (class, its characters, bits per character at which a window counts), the narrowest class first.
CLASSES = (
    ("hex", _DIGITS + "abcdef", 2.75),
    ("alphanumeric", _DIGITS + _LETTERS, 3.25),
    ("base64", _DIGITS + _LETTERS + _LETTERS.upper() + "+/_=-", 3.5),
)
_RUN = "[A-Za-z0-9+/_=-]"
CANDIDATE = rf"(?<!{_RUN})(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])({_RUN}{{{WINDOW},}}+)"
#: Candidates that are no secrets: identifiers, placeholders, counting sequences.
ALLOWED = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)example|placeholder|changeme|xxxx|0123456789|123456789|abcdefgh",
)
#: Text right before a candidate that marks it as a published digest or as data.
ALLOWED_PREFIX = r"(?i)(sha-?(1|256|384|512)|md5|integrity|checksum|digest|commit|base64)[\x20\"'=:,-]*$"

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def located(text: Column, pattern: str, group: int) -> Column:
    """Matches of ``pattern`` as structs of start, the whole match, the group and the text before the match."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("group"))
    empty = F.array().cast("array<struct<start:int,match:string,group:string,gap:string>>")
    step = lambda a, x: F.struct(
        (a["at"] + F.char_length(x["gap"]) + F.char_length(x["match"])).alias("at"),
        F.concat(a["found"], F.array(F.struct((a["at"] + F.char_length(x["gap"])).alias("start"), x["match"].alias("match"),
                                              x["group"].alias("group"), x["gap"].alias("gap")))).alias("found"))
    # The last gap has no match behind it.
    return F.aggregate(F.filter(parts, lambda x: x["match"].isNotNull()),
                       F.struct(F.lit(0).alias("at"), empty.alias("found")), step, lambda a: a["found"])


def _spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"),
                                                 (x["start"] + F.char_length(x["match"])).alias("end")))


def base_spans(text: Column, kind: int) -> Column:
    _, guard, pattern, group, least = BASE[kind]
    long = F.filter(located(text, pattern, group), lambda x: F.char_length(x["group"]) >= least)
    return F.when(text.rlike(guard), _spans(long, kind)).otherwise(F.array().cast(_SPAN))


def _c_log_c(n: Column) -> Column:
    """n * log2(n) of a count."""
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(0.0)


def hot_range(candidate: Column, alphabet: str, bits: float) -> Column:
    """(first, last): starts of the first and the last window that reach ``bits``; first is -1 if none does."""
    chars = F.split(candidate, "")
    place = lambda c: F.instr(F.lit(alphabet), c) - 1
    start = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("at"),
                     F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    # Entropy is log2(WINDOW) - sum / WINDOW, so it is high where the sum is low.
    most = (math.log2(WINDOW) - bits) * WINDOW + 1e-9

    def step(a: Column, x: Column) -> Column:
        leaving = a["at"] >= WINDOW
        enter, leave = x["enter"], x["leave"]
        grown = F.get(a["counts"], enter)
        up = a["sum"] + _c_log_c(grown + 1) - _c_log_c(grown)
        held = F.get(a["counts"], leave) + F.when(enter == leave, 1).otherwise(0)
        total = F.when(leaving, up + _c_log_c(held - 1) - _c_log_c(held)).otherwise(up)
        counts = F.transform(a["counts"], lambda v, i: v + F.when(i == enter, 1).otherwise(0)
                             - F.when(leaving & (i == leave), 1).otherwise(0))
        hot = (a["at"] + 1 >= WINDOW) & (total <= most)
        begin = a["at"] + 1 - WINDOW
        return F.struct(counts.alias("counts"), total.alias("sum"), (a["at"] + 1).alias("at"),
                        F.when(hot & (a["first"] < 0), begin).otherwise(a["first"]).alias("first"),
                        F.when(hot, begin).otherwise(a["last"]).alias("last"))

    moves = let(chars, lambda cs: F.transform(cs, lambda c, i: F.struct(
        place(c).alias("enter"), F.coalesce(place(F.get(cs, i - WINDOW)), F.lit(0)).alias("leave"))))
    return F.aggregate(moves, start, step, lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")))


def _class_range(candidate: Column) -> Column:
    """The hot range of a candidate by the narrowest class that has all its characters."""
    out = None
    for _, alphabet, bits in reversed(CLASSES):
        own = hot_range(candidate, alphabet, bits)
        out = own if out is None else F.when(F.translate(candidate, alphabet, "") == "", own).otherwise(out)
    return out


def entropy_spans(text: Column) -> Column:
    """Spans of the windows of high entropy."""
    kind = KINDS.index("entropy")
    wanted = F.filter(located(text, CANDIDATE, 1), lambda x: ~(
        x["group"].rlike("|".join(f"(?:{p})" for p in ALLOWED)) | F.right(x["gap"], F.lit(24)).rlike(ALLOWED_PREFIX)))
    ranged = F.transform(wanted, lambda x: F.struct(x["start"].alias("start"), _class_range(x["group"]).alias("hot")))
    hot = F.filter(ranged, lambda x: x["hot"]["first"] >= 0)
    spans = F.transform(hot, lambda x: F.struct((x["start"] + x["hot"]["first"]).alias("start"), F.lit(kind).alias("kind"),
                                                (x["start"] + x["hot"]["last"] + WINDOW).alias("end")))
    return F.when(text.rlike(CANDIDATE), spans).otherwise(F.array().cast(_SPAN))


def scanned(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with ``base_spans`` and ``all_spans``: arrays of (start, kind, end), sorted."""
    text = F.coalesce(text_col, F.lit(""))
    found = docs.select(*docs.columns, *(base_spans(text, k).alias(f"_{k}") for k in range(len(BASE))),
                        entropy_spans(text).alias("_added"))
    base = F.sort_array(F.flatten(F.array(*(F.col(f"_{k}") for k in range(len(BASE))))))
    found = found.withColumn("base_spans", base)
    fresh = F.filter("_added", lambda x: ~F.exists("base_spans", lambda b: (b["start"] <= x["start"]) & (b["end"] >= x["end"])))
    return (found.withColumn("all_spans", F.sort_array(F.concat("base_spans", fresh)))
            .drop("_added", *(f"_{k}" for k in range(len(BASE)))))


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with a mark in place of every span; overlapping spans share one."""
    step = lambda a, x: F.struct(
        F.when(x["start"] >= a["at"], F.concat(a["out"], F.substring(text, a["at"] + 1, x["start"] - a["at"]), F.lit(mark)))
        .otherwise(a["out"]).alias("out"), F.greatest(a["at"], x["end"]).alias("at"))
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    rest = lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, step, rest)).otherwise(text)

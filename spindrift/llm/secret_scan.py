"""Secret scans: three fixed patterns, and character Markov models for strings that look random.

The patterns (assignments, access keys, hexadecimal runs) give the base spans. Beyond them, runs of at
least `MIN_LENGTH` key characters are compared under two first-order character models: one of random
strings, one of ordinary identifiers. The models are counted from labelled samples (`samples`: made from
fixed lists with a fixed seed, or passed in). A run whose mean log-likelihood ratio per character is at
least `THRESHOLD` is a span of kind "random". In any other run, a fold finds the stretches whose ratios add
up to `EVIDENCE` or more above `THRESHOLD` a character (a stretch ends where the sum falls to 0, or by
`FALL` from its top), and each is a span, moved to the borders of its piece between = / _ and -; so a key
joined to ordinary text is found. Base spans are blanked before runs are looked for: what is left of a run
beside one is judged by itself.

Positions are code points, ends exclusive. SQL functions give matches but no positions, so a text is
split at a pattern's matches and the lengths of gaps and matches are summed. All of it is DataFrame
functions, row by row: no shuffle, no Python.

Results for odd input: null or empty text has no spans (the hash is that of the empty string); null
doc_ids and repeated rows keep their rows; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import literal_doubles

#: Fixed patterns, in the order of their kinds.
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
MIN_LENGTH = 20
RUN = f"[A-Za-z0-9+/_=-]{{{MIN_LENGTH},}}"
THRESHOLD = 0.75
EVIDENCE, FALL = 12.0, 6.0
#: Characters at the start of a stretch in which a border of pieces is looked for before it.
EDGE = 4
#: The characters of a run lie between these codes.
FIRST, LAST = 43, 122
SPAN = LAST - FIRST + 1

#: Fixed word list for the samples of ordinary identifiers.
WORDS = (
    "get set user name index value count total list item node path file read write open close start stop end begin "
    "time date year month day hour minute second size length width height color image text string number integer float "
    "boolean array object class method function return import export module package version release build test debug "
    "error warning message log level config option parameter default result response request server client host port "
    "address network socket connection session cookie header body content type format parse render update delete create "
    "insert select order group filter search query table column row key primary foreign account profile address email "
    "phone city country language translation international organization information communication understanding "
    "responsibility characteristic environment development management department government application configuration "
    "authentication authorization transaction notification subscription registration administration documentation "
    "implementation representation transformation visualization optimization initialization synchronization the and with "
    "that this from which would their other about through between another because without something everything "
    "verantwortung geschwindigkeit zusammenarbeit wissenschaft gesellschaft entwicklung freundschaft aujourdhui "
    "gouvernement developpement connaissance naturellement universidad responsabilidad desarrollo conocimiento"
).split()


def samples(n: int = 4000, seed: int = 7) -> list[tuple[str, int]]:
    """Labelled strings: n random ones (1) over the alphabets that keys use, n ordinary identifiers (0)."""
    r, out = random.Random(seed), []
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    alphabets = [digits + "abcdef", digits + upper, digits + lower + upper, digits + lower, digits + lower + upper + "+/", digits + lower + upper + "-_"]
    for k in range(n):
        out.append(("".join(r.choices(alphabets[k % len(alphabets)], k=r.randint(20, 48))), 1))
        parts = [r.choice(WORDS) for _ in range(r.randint(2, 6))]
        style = k % 7
        text = ["_", "-", "", "", "/", "", "="][style].join(p.capitalize() if style in (2, 3) else p.upper() if style == 5 else p for p in parts)
        if style == 6:
            text = r.choice("-=_+/") * r.randint(20, 60) if k % 14 == 6 else text + str(r.randint(0, 2030))
        out.append((text, 0))
    return out


def ratios(labelled: list[tuple[str, int]]) -> list[float]:
    """The log-likelihood ratio, random against ordinary, of each step from one character to the next."""
    counts = [[[0.25] * SPAN for _ in range(SPAN)] for _ in range(2)]
    for text, label in labelled:
        for a, b in zip(text, text[1:]):
            if FIRST <= ord(a) <= LAST and FIRST <= ord(b) <= LAST:
                counts[label][ord(a) - FIRST][ord(b) - FIRST] += 1
    sums = [[sum(row) for row in c] for c in counts]
    return [math.log(counts[1][a][b] / sums[1][a]) - math.log(counts[0][a][b] / sums[0][a]) for a in range(SPAN) for b in range(SPAN)]


def _matches(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """array<struct<start, kind, end, hit>> of the matches, hit being the text of the group."""
    gaps, whole = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    hit = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    sized = F.zip_with(F.transform(F.slice(gaps, F.lit(1), F.size(whole)), lambda g: F.length(g)), F.arrays_zip(whole.alias("w"), hit.alias("h")), lambda g, m: F.struct(g.alias("gap"), F.length(m["w"]).alias("size"), m["h"].alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,hit:string>>").alias("out"))

    def add(a: Column, m: Column) -> Column:
        begin = a["at"] + m["gap"]
        one = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), (begin + m["size"]).alias("end"), m["hit"].alias("hit"))
        return F.struct((begin + m["size"]).alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

    return F.aggregate(sized, start, add, lambda a: a["out"])


def _blanked(text: Column, spans: Column) -> Column:
    """`text` with a space for every character of `spans`, which are in order."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, m: Column) -> Column:
        start, end = F.greatest(a["at"], m["start"]), F.greatest(a["at"], m["end"])
        return F.struct(end.alias("at"), F.concat(a["out"], F.substr(text, a["at"] + 1, start - a["at"]), F.repeat(F.lit(" "), end - start)).alias("out"))

    return F.aggregate(spans, begin, step, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1)))


NONE = "array<struct<start:int,kind:int,end:int,hit:string>>"


def secrets(docs: DataFrame, labelled: list[tuple[str, int]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, spans) for every row of `docs` (doc_id, text): spans are (start, kind, end, hit, score), by start and kind.

    `hit` is the secret itself (an assignment's value), `score` the ratio of random runs.
    """
    table = literal_doubles(ratios(labelled or samples()))
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    none = F.array().cast(NONE)
    low = F.lower("t")
    named = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("key")
    d = d.withColumn("a", F.when(named, _matches(F.col("t"), ASSIGN, 0, 2)).otherwise(none))
    d = d.withColumn("a", F.filter("a", lambda m: F.length(m["hit"]) >= 8))
    d = d.withColumn("k", F.when(F.col("t").contains("AKIA"), _matches(F.col("t"), ACCESS, 1)).otherwise(none))
    d = d.withColumn("k", F.filter("k", lambda m: m["end"] - m["start"] >= 16))
    # runs of 32 or more and their places are the same as those of all runs, shorter ones dropped
    d = d.withColumn("h", F.when(F.col("t").rlike("[0-9a-f]{32}"), _matches(F.col("t"), HEX.replace("+", "{32,}"), 2)).otherwise(none))
    d = d.withColumn("base", F.sort_array(F.concat("a", "k", "h")))
    # the text with blanks for base spans, places unchanged
    rest = F.when(F.size("base") == 0, F.col("t")).otherwise(_blanked(F.col("t"), F.col("base")))
    d = d.withColumn("u", F.when(F.col("t").rlike(RUN), rest))
    d = d.withColumn("r", F.when(F.col("u").rlike(RUN), _matches(F.col("u"), RUN, 3)).otherwise(none))
    d = d.select("doc_id", "base", "r")

    def stretches(m: Column) -> Column:
        """array<struct<b, e, score>> of a run: itself, or its stretches, from 0."""
        hit = m["hit"]
        n = F.length(hit)
        codes = F.transform(F.split(hit, ""), lambda c: F.ascii(c) - FIRST)  # the run is cut into characters once
        ratio = lambda a, b: F.get(table, a * SPAN + b)
        values = F.zip_with(F.slice(codes, F.lit(1), n - 1), F.slice(codes, F.lit(2), n - 1), ratio)
        mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / (n - 1)
        zero, at = F.lit(0.0), F.lit(0)
        begin = F.struct(zero.alias("s"), zero.alias("m"), at.alias("b"), at.alias("e"), F.array().cast("array<struct<b:int,e:int,score:double>>").alias("out"))
        found = lambda a: F.when(a["m"] >= EVIDENCE, F.concat(a["out"], F.array(F.struct(a["b"].alias("b"), (a["e"] + 1).alias("e"), (a["m"] / (a["e"] - a["b"]) + threshold).alias("score"))))).otherwise(a["out"])

        def step(a: Column, x: Column) -> Column:
            def of(s: Column) -> Column:
                ended = F.struct(zero.alias("s"), zero.alias("m"), x["i"].alias("b"), x["i"].alias("e"), found(a).alias("out"))
                higher = F.struct(s.alias("s"), s.alias("m"), a["b"].alias("b"), x["i"].alias("e"), a["out"].alias("out"))
                lower = F.struct(s.alias("s"), a["m"].alias("m"), a["b"].alias("b"), a["e"].alias("e"), a["out"].alias("out"))
                return F.when((s <= 0) | (s < a["m"] - FALL), ended).when(s > a["m"], higher).otherwise(lower)

            return F.get(F.transform(F.array(a["s"] + x["v"] - threshold), of), F.lit(0))  # the sum is made once

        steps = F.transform(values, lambda v, i: F.struct((i + 1).alias("i"), v.alias("v")))
        whole = lambda score: F.array(F.struct(at.alias("b"), n.alias("e"), score.alias("score")))
        return F.flatten(F.transform(F.array(mean), lambda score: F.when(score >= threshold, whole(score)).otherwise(F.aggregate(steps, begin, step, found))))

    def bordered(m: Column, x: Column) -> Column:
        """The span of a stretch: from the border in its first characters, or the one before it, to the one after it."""
        hit = m["hit"]
        head = F.length(F.regexp_extract(F.substr(hit, x["b"] + 1, F.lit(EDGE)), "^.*[=/_-]", 0))
        before = F.length(F.regexp_extract(F.substr(hit, F.lit(1), x["b"]), "[^=/_-]*$", 0))
        after = F.length(F.regexp_extract(F.substr(hit, x["e"] + 1), "^[^=/_-]*", 0))
        whole = (x["b"] == 0) & (x["e"] == F.length(hit))
        b = F.when(whole, x["b"]).otherwise(F.when(head > 0, x["b"] + head).otherwise(x["b"] - before))
        e = x["e"] + after
        return F.struct((m["start"] + b).alias("start"), m["kind"].alias("kind"), (m["start"] + e).alias("end"), F.substr(hit, b + 1, e - b).alias("hit"), x["score"].alias("score"))

    fields = lambda m, s: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"), m["hit"].alias("hit"), s.alias("score"))
    found = F.flatten(F.transform("r", lambda m: F.transform(stretches(m), lambda x: bordered(m, x))))
    base = F.transform("base", lambda m: fields(m, F.lit(None).cast("double")))
    return d.select("doc_id", F.sort_array(F.concat(base, found)).alias("spans"))


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", F.get(kinds, m["kind"]), m["start"].cast("string"), m["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of `docs`."""
    s = secrets(docs)
    count = lambda k: F.size(F.filter("spans", lambda m: m["kind"] == k)).cast("long")
    base = _listed(F.filter("spans", lambda m: m["kind"] < 3))
    return s.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(base, 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """`docs` with every span of `text` replaced by `mark`; overlapping spans become one. Null texts stay null."""
    cols = docs.columns
    s = secrets(docs.withColumn("doc_id", F.struct(*[F.col(f"`{c}`") for c in cols]))).withColumn("t", F.col("doc_id.text"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, m: Column) -> Column:
        fresh = m["start"] >= a["at"]
        return F.struct(F.greatest(a["at"], m["end"]).alias("at"), F.when(fresh, F.concat(a["out"], F.substr(F.col("t"), a["at"] + 1, m["start"] - a["at"]), F.lit(mark))).otherwise(a["out"]).alias("out"))

    clean = F.aggregate("spans", start, step, lambda a: F.concat(a["out"], F.substr(F.col("t"), a["at"] + 1)))
    return s.select("doc_id.*", clean.alias("_clean")).withColumn("text", F.col("_clean")).select(*cols)

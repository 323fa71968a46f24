"""Secret scans behind a trigram inverted index; spans come from split lengths, all in DataFrame functions."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as C
from re import _parser as P

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, sieve


@dataclass(frozen=True)
class Rule:
    """kind: its name in spans. A match counts if group `group` of it has `least` characters or more."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


#: The first three are fixed by contract; the order is the order of kinds.
RULES = [
    Rule("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"ghp_[A-Za-z0-9]{36,}"),
]
BASE = ("assign", "access", "hex")

#: A Boolean trigram query: None (no condition), a trigram, ("and", [...]) or ("or", [...]).
Query = object


def _and(parts: list[Query]) -> Query:
    flat = [q for p in parts if p is not None for q in (p[1] if isinstance(p, tuple) and p[0] == "and" else [p])]
    return None if not flat else flat[0] if len(flat) == 1 else ("and", flat)


def _literal(text: str) -> Query:
    text = text.lower()
    return _and([text[i : i + 3] for i in range(len(text) - 2)])


def trigram_query(pattern: str) -> Query:
    """What every match must hold, in lower-cased trigrams: sequences and, alternatives or; anything else breaks a run.

    None where the pattern has no mandatory trigram.
    """

    def walk(items) -> Query:
        parts: list[Query] = []
        run = ""
        for op, arg in items:
            if op is C.LITERAL and arg < 128:
                run += chr(arg)
                continue
            parts.append(_literal(run))
            run = ""
            if op is C.SUBPATTERN:
                parts.append(walk(arg[-1]))
            elif op is C.BRANCH:
                branches = [walk(b) for b in arg[1]]
                parts.append(None if None in branches else ("or", branches))
            elif op is C.MAX_REPEAT and arg[0] > 0:
                parts.append(walk(arg[2]))
        parts.append(_literal(run))
        return _and(parts)

    tree = P.parse(pattern)
    # an alternation's common prefix is factored out by the parser; spelled-out branches are read from the source instead
    whole = re.match(r"(?:\(\?i\))?\(([\w|?]+)\)", pattern)
    if whole and "|" in whole[1]:
        first = [walk(P.parse(b)) for b in whole[1].split("|")]
        rest = walk(P.parse(pattern[whole.end() :]))
        return _and([None if None in first else ("or", first), rest])
    return walk(tree)


def trigrams(query: Query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


#: Trigrams that one long holds a bit for.
MASK = 62


def _doc_key() -> list[Column]:
    """A row of docs: its id and what its text hashes to, so that a repeated or null id does no harm."""
    return [F.coalesce(F.col("doc_id"), F.lit(-1)).alias("k"), F.xxhash64("text").alias("h")]


def build_index(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Postings (term, k, h): the rows of docs whose lower-cased text holds a trigram; term is its place in terms."""
    low = docs.select(*_doc_key(), F.lower("text").alias("low"))
    held = F.filter(F.array(*[F.when(F.col("low").contains(t), F.lit(i)) for i, t in enumerate(terms)]), lambda x: x.isNotNull())
    return low.select("k", "h", F.explode(held).alias("term"))


def _holds(query: Query, place: dict[str, int]) -> Column:
    if isinstance(query, str):
        word, bit = divmod(place[query], MASK)
        return F.expr(f"masks[{word}] & {1 << bit}L <> 0")
    op = (lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b)
    return reduce(op, [_holds(q, place) for q in query[1]])


def candidates(index: DataFrame, rules: list[Rule], terms: list[str]) -> DataFrame:
    """(k, h, one boolean per rule): postings intersected by document, the rule's query decided on the terms they hold."""
    place = {t: i for i, t in enumerate(terms)}
    masks = [F.expr(f"bit_or(if(term div {MASK} = {i}, shiftleft(1L, cast(term % {MASK} as int)), 0L))") for i in range(-(-len(terms) // MASK))]
    lists = index.groupBy("k", "h").agg(F.array(*masks).alias("masks"))
    marks = lists.select("k", "h", *[_holds(trigram_query(r.pattern), place).alias(r.kind) for r in rules])
    return marks.filter(reduce(lambda a, b: a | b, [F.col(r.kind) for r in rules]))


#: Matches whose places are added up in one go: an array that grows is copied at each step, so it has to stay short.
MATCHES = 256


def _once(value: Column, use) -> Column:
    """use(value), with value computed once a row however often use names it, also inside functions of array elements."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(rule: Rule, number: int, when: Column | None = None) -> Column:
    """array<struct<start, number, end, kind>> of the rule's matches in text.

    Matches don't overlap and are the same for split and regexp_extract_all, so the lengths of the pieces between
    them give their places in code points.
    """
    found = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    if when is not None:
        found = F.when(when, found).otherwise(F.array().cast("array<string>"))
    span = "array<struct<start:int,number:int,end:int,kind:string>>"

    def step(s, x):
        begin = s["at"] + x["a"]
        end = begin + x["b"]
        own = F.struct(begin.alias("start"), F.lit(number).alias("number"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct(end.alias("at"), F.when(x["held"], F.concat(s["out"], F.array(own))).otherwise(s["out"]).alias("out"))

    def placed(blocks: Column) -> Column:
        """The spans of blocks of matches, from the running sum of their lengths."""
        length = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x["a"] + x["b"]))
        begin = F.aggregate(length, F.array(F.lit(0)), lambda s, n: F.concat(s, F.array(F.element_at(s, -1) + n)))
        first = lambda at: F.struct(at.alias("at"), F.array().cast(span).alias("out"))
        return F.flatten(F.zip_with(blocks, F.slice(begin, 1, F.size(blocks)), lambda b, at: F.aggregate(b, first(at), step, lambda s: s["out"])))

    held = lambda m: F.length(F.regexp_extract(m, rule.pattern, rule.group) if rule.group else m) >= rule.least
    sized = lambda pieces, found: F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda a, m: F.struct(F.length(a).alias("a"), F.length(m).alias("b"), held(m).alias("held")))
    cut = lambda steps: F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / MATCHES).cast("int")), lambda i: F.slice(steps, i * MATCHES + 1, F.lit(MATCHES)))
    spans = _once(found, lambda m: F.when(F.size(m) > 0, _once(_once(sized(F.split("text", rule.pattern, -1), m), cut), placed)))
    return F.coalesce(spans, F.array().cast(span))


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """(doc_id, spans array<struct<start, number, end, kind>>): one row per row of docs, spans by start, then rule.

    Null text counts as empty and has no spans; rows with the same id and text are rows of their own; an empty table
    gives no rows; columns besides doc_id and text aren't read. Rules with mandatory trigrams are verified on the index's
    candidates only; the others read every text.
    """
    rules = RULES if rules is None else rules
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    number = {r.kind: i for i, r in enumerate(rules)}
    indexed = [r for r in rules if trigram_query(r.pattern) is not None]
    fully = [r for r in rules if r not in indexed]
    none = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
    # the verified spans of all rules of one text, few beside the text
    everywhere = docs.select("doc_id", *_doc_key(), (F.concat(*[_spans(r, number[r.kind]) for r in fully]) if fully else none).alias("found"))
    if indexed:
        terms = sorted(set().union(*[trigrams(trigram_query(r.pattern)) for r in indexed]))
        index = saved(build_index(docs, terms), "trigram-index")
        hits = saved(candidates(index, indexed, terms), "trigram-hits")
        texts = sieve(docs.select("text", *_doc_key()), F.col("h"), hits, "h").join(hits, ["k", "h"])
        checked = texts.select("k", "h", F.concat(*[_spans(r, number[r.kind], F.col(r.kind)) for r in indexed]).alias("more"))
        checked = saved(checked.filter("size(more) > 0").groupBy("k", "h").agg(F.first("more").alias("more")), "trigram-checked")
        everywhere = everywhere.join(checked, ["k", "h"], "left").withColumn("found", F.concat("found", F.coalesce("more", none)))
    return everywhere.select("doc_id", F.array_sort("found").alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

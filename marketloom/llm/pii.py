"""Format-preserving pseudonyms for personal data by keyed Feistel networks, all in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Kinds and their patterns, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,4}\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)",
    "date": r"(?<![\w/.-])\d{4}-\d{2}-\d{2}(?![\w/-])",
    "phone": r"(?<!\w)(?:\+1 ?)?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\w)",
    "card": r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)",
}
KINDS = list(PATTERNS)
PATTERN = "|".join(PATTERNS.values())
#: Dates from 1899-12-31 on, 150 * 487 days: up to 2099-12-31.
FIRST_DAY, DAYS_LEFT, DAYS_RIGHT = "DATE'1899-12-31'", 150, 487


def _draw(key: str, tag: str, i: str, x: str) -> str:
    """60 bits that key, round and the other half decide."""
    return f"cast(conv(substring(sha2(concat('{key}|{tag}|', cast({i} as string), '|', cast({x} as string)), 256), 1, 15), 16, 10) as bigint)"


def _pair(key: str, tag: str, left: str, right: str, m: str, n: str, back: bool) -> str:
    """Feistel on a pair of numbers below m and n: even rounds move the left one, odd rounds the right one."""
    rounds = f"sequence({ROUNDS - 1}, 0)" if back else f"sequence(0, {ROUNDS - 1})"
    sign = "-" if back else "+"
    a = f"if(i % 2 = 0, pmod(s.l {sign} {_draw(key, tag, 'i', 's.r')} % ({m}), {m}), s.l)"
    b = f"if(i % 2 = 1, pmod(s.r {sign} {_draw(key, tag, 'i', 's.l')} % ({n}), {n}), s.r)"
    begin = f"named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint))"
    return f"aggregate({rounds}, {begin}, (s, i) -> named_struct('l', cast({a} as bigint), 'r', cast({b} as bigint)))"


def _into(text: str, digits: str) -> str:
    """text with its digits replaced by those of digits, one by one."""
    step = f"if(c rlike '[0-9]', named_struct('n', s.n + 1, 'o', concat(s.o, substring({digits}, s.n, 1))), named_struct('n', s.n, 'o', concat(s.o, c)))"
    return f"aggregate(filter(split({text}, ''), c -> c <> ''), named_struct('n', 1, 'o', ''), (s, c) -> {step}, s -> s.o)"


def _luhn(digits: str) -> str:
    """The sum of Luhn's rule, counted from the right; digits is a string."""
    value = f"cast(substring({digits}, -j, 1) as int)"
    return f"aggregate(sequence(1, length({digits})), 0, (t, j) -> t + if(j % 2 = 1, {value}, {value} * 2 - if({value} > 4, 9, 0)))"


def _card(key: str, m: str, back: bool) -> str:
    """The first digit stays, the last is the check digit, those between are permuted. NULL unless Luhn's rule holds."""
    size = "length(d)"
    u, v = f"(({size} - 1) div 2)", f"({size} - 2 - ({size} - 1) div 2)"
    pair = _pair(key, "card", f"substring(d, 2, {u})", f"substring(d, 2 + {u}, {v})", f"cast(pow(10, {u}) as bigint)", f"cast(pow(10, {v}) as bigint)", back)
    body = f"concat(substring(d, 1, 1), lpad(cast(p.l as string), {u}, '0'), lpad(cast(p.r as string), {v}, '0'))"
    check = f"cast(pmod(10 - {_luhn('concat(b, \"0\")')} % 10, 10) as string)".replace('"', "'")
    made = f"element_at(transform(array({pair}), p -> element_at(transform(array({body}), b -> concat(b, {check})), 1)), 1)"
    inner = f"if({_luhn('d')} % 10 = 0, {_into(m, made)}, NULL)"
    return f"element_at(transform(array(regexp_replace({m}, '[^0-9]', '')), d -> {inner}), 1)"


def _phone(key: str, m: str, back: bool) -> str:
    """Area code and exchange with a first digit of 2 to 9 keep one of these, those with 0 or 1 one of those; a leading +1 stays."""
    ten = f"right(regexp_replace({m}, '[^0-9]', ''), 10)"
    # least numbers of both parts' classes: 200 or 0, 2000000 or 0
    low = f"named_struct('a', if(substring({ten}, 1, 1) >= '2', 200, 0), 'b', if(substring({ten}, 4, 1) >= '2', 2000000, 0))"
    left, right = f"cast(substring({ten}, 1, 3) as int) - w.a", f"cast(substring({ten}, 4, 7) as int) - w.b"
    pair = _pair(key, "phone", left, right, "if(w.a = 0, 200, 800)", "if(w.b = 0, 2000000, 8000000)", back)
    made = "concat(lpad(cast(p.l + w.a as string), 3, '0'), lpad(cast(p.r + w.b as string), 7, '0'))"
    lead = f"length({m}) - length(regexp_replace({m}, '^[+]1 ?', ''))"
    filled = f"concat(substring({m}, 1, {lead}), {_into(f'substring({m}, {lead} + 1)', made)})"
    return f"element_at(transform(array({low}), w -> element_at(transform(array({pair}), p -> {filled}), 1)), 1)"


def _ip(key: str, m: str, back: bool) -> str:
    """NULL unless each of the four numbers is below 256 and written without leading zeros."""
    o = f"transform(split({m}, '[.]'), x -> cast(x as int))"
    pair = _pair(key, "ip", "o[0] * 256 + o[1]", "o[2] * 256 + o[3]", "65536", "65536", back)
    made = f"element_at(transform(array({pair}), p -> concat_ws('.', cast(p.l div 256 as string), cast(p.l % 256 as string), cast(p.r div 256 as string), cast(p.r % 256 as string))), 1)"
    return f"element_at(transform(array({o}), o -> if(forall(o, x -> x < 256) and concat_ws('.', transform(o, x -> cast(x as string))) = {m}, {made}, NULL)), 1)"


def _date(key: str, m: str, back: bool) -> str:
    """NULL unless it is a day of the calendar from 1899-12-31 to 2099-12-31."""
    n = f"datediff(try_cast({m} as date), {FIRST_DAY})"
    pair = _pair(key, "date", f"n div {DAYS_RIGHT}", f"n % {DAYS_RIGHT}", str(DAYS_LEFT), str(DAYS_RIGHT), back)
    made = f"element_at(transform(array({pair}), p -> date_format(date_add({FIRST_DAY}, cast(p.l * {DAYS_RIGHT} + p.r as int)), 'yyyy-MM-dd')), 1)"
    return f"element_at(transform(array({n}), n -> if(n between 0 and {DAYS_LEFT * DAYS_RIGHT - 1}, {made}, NULL)), 1)"


def _email(key: str, m: str, back: bool) -> str:
    """Feistel on halves of the name: letters move among letters of their case, digits among digits; the host's name
    takes part in the same way, its last label stays."""
    stem = f"regexp_extract({m}, '^(.*)[.][A-Za-z]+$', 1)"
    rounds = f"sequence({ROUNDS - 1}, 0)" if back else f"sequence(0, {ROUNDS - 1})"
    sign = "-" if back else "+"
    byte = "cast(conv(substring(h, 1 + 2 * (k % 64), 2), 16, 10) as int)"

    def moved(half: str, other: str) -> str:
        hashed = f"sha2(concat('{key}|email|', cast(i as string), '|', array_join({other}, '')), 512)"
        turn = lambda first, n: f"chr({first} + pmod(ascii(c) - {first} {sign} {byte} % {n}, {n}))"
        one = f"case when c rlike '[a-z]' then {turn(97, 26)} when c rlike '[A-Z]' then {turn(65, 26)} when c rlike '[0-9]' then {turn(48, 10)} else c end"
        return f"element_at(transform(array({hashed}), h -> transform({half}, (c, k) -> {one})), 1)"

    step = f"named_struct('l', if(i % 2 = 0, {moved('s.l', 's.r')}, s.l), 'r', if(i % 2 = 1, {moved('s.r', 's.l')}, s.r))"
    chars = f"filter(split({stem}, ''), c -> c <> '')"
    begin = "named_struct('l', slice(a, 1, size(a) div 2), 'r', slice(a, 1 + size(a) div 2, size(a)))"
    made = f"aggregate({rounds}, {begin}, (s, i) -> {step}, s -> concat(array_join(s.l, ''), array_join(s.r, '')))"
    return f"element_at(transform(array({chars}), a -> concat({made}, substring({m}, length({stem}) + 1))), 1)"


def _kind(m: str) -> str:
    return (
        f"case when contains({m}, '@') then 'email' when {m} rlike '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$' then 'ip' "
        f"when {m} rlike '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' then 'date' "
        f"when {m} rlike '^([+]1 ?)?[(]?[0-9]{{3}}[)]?[ .-][0-9]{{3}}[ .-][0-9]{{4}}$' then 'phone' else 'card' end"
    )


def _swap(key: str, m: str, back: bool) -> str:
    cases = {"email": _email, "ip": _ip, "date": _date, "phone": _phone, "card": _card}
    return f"case {_kind(m)} " + " ".join(f"when '{k}' then {f(key, m, back)}" for k, f in cases.items()) + " end"


def pseudonymise(docs: DataFrame, key: str, back: bool = False) -> DataFrame:
    """doc_id, text with validated personal data replaced, n_email, n_ip, n_date, n_phone, n_card: one row per row of docs.

    Each value becomes another of its format under the key, the same in every document, so equal values stay linked;
    with back=True the same key restores the text. Strings that fail validation (Luhn, octets, calendar) stay as they are.
    Null text stays null with counts 0; an empty table gives no rows; columns besides doc_id and text are not read.
    """
    if not key.isalnum():
        raise ValueError("the key must be letters and digits")
    found = docs.select("doc_id", "text", F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("found"))
    made = found.withColumn("made", F.expr(f"transform(found, m -> named_struct('kind', {_kind('m')}, 'old', m, 'new', {_swap(key, 'm', back)}))"))
    pieces = F.split("text", PATTERN, -1)
    filled = F.expr("transform(made, x -> coalesce(x.new, x.old))")
    woven = F.zip_with(pieces, filled, lambda p, x: F.concat(p, F.coalesce(x, F.lit(""))))
    text = F.when(F.size("found") > 0, F.array_join(woven, "")).otherwise(F.col("text"))
    counts = [F.expr(f"cast(coalesce(size(filter(made, x -> x.kind = '{k}' and x.new is not null)), 0) as bigint)").alias(f"n_{k}") for k in KINDS]
    counts = [F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(c).alias(f"n_{k}") for c, k in zip(counts, KINDS, strict=True)]
    return made.select("doc_id", text.alias("text"), *counts)

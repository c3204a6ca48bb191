"""Personal data in texts: regular expressions propose, checksums confirm, words nearby adjust the score.

Built-in functions only; each row is treated on its own, so there is no shuffle. Positions are code points. A pattern
is applied twice: ``regexp_extract_all`` gives what matched and ``split`` what lies between, and running sums of
their lengths give the positions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import text_or_empty


@dataclass(frozen=True)
class Kind:
    """``valid``: SQL on ``v`` (the match) that a proposal must meet. ``score``: without words nearby.

    ``base`` kinds stay whatever their score; others need the threshold.
    """

    name: str
    pattern: str
    valid: str
    score: float
    near: str
    base: bool = True
    needs: str = ""


DIGITS = "regexp_replace(v, '[^0-9]', '')"
LUHN = f"""aggregate(split(reverse({DIGITS}), ''), named_struct('sum', 0, 'twice', false), (a, c) -> if(c = '', a,
    named_struct('sum', a.sum + case when not a.twice then int(c) when int(c) > 4 then 2 * int(c) - 9 else 2 * int(c) end,
        'twice', not a.twice)), a -> a.sum % 10 = 0)"""
MOD_97 = """aggregate(split(concat(substring(replace(v, ' ', ''), 5), substring(replace(v, ' ', ''), 1, 4)), ''), 0,
    (a, c) -> case when c = '' then a when c between '0' and '9' then (a * 10 + int(c)) % 97
    else (a * 100 + ascii(c) - 55) % 97 end) = 1"""

# Possessive quantifiers and the look-behinds give the same matches as the plain patterns: a run that fails at its
# start fails at each later start too, or no shorter repetition can help. They keep long runs linear and the matcher's
# stack flat. \G lets a match begin right behind the one before.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "true", 0.8, "mail|contact|write to|kontakt|correo|courriel", needs="@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"v rlike '^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:[.]|$)){4}$'",
         0.6, r"\bip\b|host|server|address|adresse|direcci", needs="."),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9]){13,}+", f"length({DIGITS}) <= 19 and {LUHN}",
         0.7, "card|visa|credit|payment|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({DIGITS}) between 10 and 15",
         0.6, r"phone|call|\btel\b|mobile|fax|telefon|appel|llama", needs="+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         MOD_97, 0.7, "iban|bank|account|konto|compte|cuenta", base=False),
    Kind("phone_local", r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])",
         "true", 0.4, r"phone|call|\btel\b|mobile|fax|telefon|appel|llama", base=False),
)
#: Words that speak against personal data.
AGAINST = r"version|isbn|serial|order|invoice|\bsku\b|example only"
PIECE = "struct<v:string,gap:int,score:double>"
SPAN = "struct<kind:string,start:int,stop:int,value:string,score:double,rank:int>"

#: Matches whose places are summed up in one array.
RUN = 256


def _literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def _pieces(kind: Kind) -> Column:
    """Matches of one kind with the length of the text before each and a score, from columns m_<name> and p_<name>;
    in runs of RUN, as a running sum in an array copies the array for each element."""
    m, p, at = f"m_{kind.name}", f"p_{kind.name}", f"int(b * {RUN} + k)"
    near = f"lower(concat(right({p}[{at}], 40), ' ', left({p}[{at} + 1], 20)))"
    score = (f"{kind.score}D + if({near} rlike {_literal(kind.near)}, 0.2D, 0D)"
             f" - if({near} rlike {_literal(AGAINST)}, 0.2D, 0D)")
    run = f"slice({m}, int(b * {RUN} + 1), {RUN})"
    return F.expr(f"""if(size({m}) = 0, cast(array() as array<array<{PIECE}>>),
        transform(sequence(0, (size({m}) - 1) div {RUN}), b -> transform({run},
            (v, k) -> named_struct('v', v, 'gap', length({p}[{at}]), 'score', {score}))))""")


def _spans(rank: int, kind: Kind) -> Column:
    """Spans of one kind from its runs of matches in column r_<name>."""
    runs = f"r_{kind.name}"
    begins = f"""aggregate(transform({runs}, r -> aggregate(r, 0, (n, x) -> n + x.gap + length(x.v))),
        named_struct('pos', 0, 'out', cast(array() as array<int>)),
        (a, n) -> named_struct('pos', a.pos + n, 'out', array_append(a.out, a.pos)), a -> a.out)"""
    walk = f"""flatten(zip_with({runs}, {begins}, (r, begin) -> aggregate(r,
        named_struct('pos', begin, 'out', cast(array() as array<{SPAN}>)),
        (a, x) -> named_struct('pos', a.pos + x.gap + length(x.v), 'out', array_append(a.out, named_struct(
            'kind', '{kind.name}', 'start', a.pos + x.gap, 'stop', a.pos + x.gap + length(x.v), 'value', x.v,
            'score', x.score, 'rank', {rank}))), a -> a.out)))"""
    valid = kind.valid.replace("(v,", "(s.value,").replace("v rlike", "s.value rlike")
    return F.expr(f"if(size({runs}) = 0, cast(array() as array<{SPAN}>), filter({walk}, s -> {valid}))")


def find_pii(docs: DataFrame, threshold: float = 0.5, into: str = "pii") -> DataFrame:
    """``docs`` with the column ``into``: an array of kind, start, stop, value, score, rank, ordered by start, then by kind.

    Kinds: email, ip (parts to 255), card (14 to 19 digits, Luhn), phone (10 to 15 digits); these always stay. iban
    (mod 97) and phone_local (no country code) are added where they score ``threshold`` or more and touch no base
    span. Words within 40 code points before and 20 behind a match raise or lower its score by 0.2.

    A null or empty text has no spans. Other columns pass through (one named as ``into`` is replaced); repeated rows are
    treated alike; very long texts are searched whole; an empty table gives no rows.
    """
    row = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
                      text_or_empty("text").alias("t"))
    found = row
    nothing = F.expr("cast(array() as array<string>)")
    for k in KINDS:
        pattern = F.lit(k.pattern)
        match = F.regexp_extract_all("t", pattern, F.lit(0))
        found = found.withColumn(f"m_{k.name}", F.when(F.instr("t", k.needs) > 0, match).otherwise(nothing)
                                 if k.needs else match)
    found = found.withColumns({f"p_{k.name}": F.when(F.size(f"m_{k.name}") > 0, F.split("t", k.pattern, -1))
                               for k in KINDS})
    found = found.withColumns({f"r_{k.name}": _pieces(k) for k in KINDS})
    found = found.withColumns({f"s_{k.name}": _spans(n, k) for n, k in enumerate(KINDS)})
    found = found.withColumn("base", F.concat(*(f"s_{k.name}" for k in KINDS if k.base)))
    added = F.concat(*(f"s_{k.name}" for k in KINDS if not k.base))
    added = F.filter(added, lambda s: (s.score >= threshold) & ~F.exists(
        "base", lambda b: (b.start < s.stop) & (s.start < b.stop)))
    ordered = F.array_sort(F.concat("base", added), lambda x, y: F.when(x.start != y.start, x.start - y.start)
                           .otherwise(x["rank"] - y["rank"]))
    return found.select(*(F.col(f"row.`{c}`") for c in docs.columns if c != into), ordered.alias(into))


def redact(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, such as [EMAIL]; spans that overlap become one.

    A null text stays null. ``n_chars``, where there is one, is counted anew for the changed texts.
    """
    spans = "pii"
    while spans in docs.columns:
        spans += "_"
    found = find_pii(docs, threshold, spans)
    swept = F.expr(f"""aggregate({spans}, named_struct('pos', 0, 'out', cast(array() as array<string>)),
        (a, s) -> if(s.start < a.pos, named_struct('pos', greatest(a.pos, s.stop), 'out', a.out),
            named_struct('pos', s.stop, 'out',
                concat(a.out, array(substring(text, a.pos + 1, s.start - a.pos), concat('[', upper(s.kind), ']'))))),
        a -> concat(array_join(a.out, ''), substring(text, a.pos + 1)))""")
    clean = found.withColumn("text", F.when(F.size(spans) > 0, swept).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.size(spans) > 0, length).otherwise(F.col("n_chars")))
    return clean.select(*(f"`{c}`" for c in docs.columns))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"),
                                                                 s.stop.cast("string"))), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, a digest of the base spans, all spans as text."""
    base = [k.name for k in KINDS if k.base]
    found = find_pii(docs.select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(pii, s -> s.kind = '{name}')) as long) AS n_{name}") for name in base]
    return found.select("doc_id", *counts, F.sha2(listed(F.filter("pii", lambda s: s.kind.isin(base))), 256)
                        .alias("base_sha256"), listed(F.col("pii")).alias("spans"),
                        F.coalesce(F.array_max(F.transform("pii", lambda s: s.score)), F.lit(0.0)).alias("top_score"))

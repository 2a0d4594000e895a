"""DuckDB SQL text equivalent to our Spark expressions, for the correctness
oracle only (``oracle_sql()`` in ``__spark_entry__``). Each helper mirrors
one function of ``cropledger.functions`` or one adapter view."""

from __future__ import annotations

from cropledger.dims import LEGAL_FORMS, NATION_COUNTRY
from cropledger.plans.testdata import MIN_SCHEME_SIZE, NO_ADDRESS_SEGMENT, YEAR_SHIFT


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# spellings of letters that don't decompose into a-z, written here apart from the library's
_SPELLED = (
    "ßss æae œoe þth ŋng ĳij ðd đd øo łl ħh ıi ŧt ŀl ĸk ſs əe "
    "αa βv γg δd εe ζz ηi θth ιi κk λl μm νn ξx οo πp ρr σs ςs τt υy φf χch ψps ωo "
    "аa бb вv гg ґg ѓgj дd ђdj еe ёe єye жzh зz ѕdz иi іi їyi йy јj кk ќkj лl љlj мm нn њnj оo пp рr сs тt "
    "ћc уu ўu фf хkh цts чch џdzh шsh щshch ъa ыy ь эe юyu яya"
).split()


def fold_sql(x: str) -> str:
    """Lower case and every letter spelled in a-z, one by one; plain ASCII as it is."""
    table = "MAP {" + ", ".join(f"{q(w[0])}: {q(w[1:])}" for w in _SPELLED) + "}"
    bare = f"regexp_replace(lower({x}), '\\p{{Mn}}', '', 'g')"
    pairs = f"regexp_replace({bare}, 'ο[υύὐὑὓὒὔὕὖὗὺύῦ]', 'ou', 'g')"
    pairs = f"regexp_replace({pairs}, '([αεη])[υύὐὑὓὒὔὕὖὗὺύῦ]', '\\1v', 'g')"
    pairs = f"regexp_replace({pairs}, 'γ([γξχ])', 'n\\1', 'g')"
    letter = f"coalesce(map_extract_value({table}, c), map_extract_value({table}, strip_accents(c)), strip_accents(c))"
    spelled = f"array_to_string(list_transform(string_split({pairs}, ''), lambda c: {letter}), '')"
    return f"CASE WHEN regexp_matches({x}, '[^\\x00-\\x7f]') THEN {spelled} ELSE lower({x}) END"


def fingerprint_sql(x: str) -> str:
    t = f"regexp_replace({fold_sql(x)}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')"
    for long_form, short_form in LEGAL_FORMS:
        t = f"regexp_replace({t}, {q(chr(92) + 'b' + long_form + chr(92) + 'b')}, {q(short_form)}, 'g')"
    joined = (
        f"array_to_string(list_sort(list_distinct(list_filter(string_split(trim({t}), ' '), "
        f"lambda w: w <> ''))), ' ')"
    )
    return f"nullif({joined}, '')"


def entity_id_sql(*parts: str) -> str:
    texts = [f"CAST({p} AS VARCHAR)" for p in parts]
    return (
        f"CASE WHEN coalesce({', '.join(texts)}) IS NULL THEN NULL "
        f"ELSE sha1(concat_ws(chr(31), {', '.join(texts)})) END"
    )


def normalize_scheme_sql(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def scheme_id_sql(x: str) -> str:
    return entity_id_sql(normalize_scheme_sql(x))


def country_sql(nationkey: str) -> str:
    codes = ", ".join(q(c) for c in NATION_COUNTRY)
    return f"list_value({codes})[{nationkey} + 1]"


def num(x: str) -> str:
    """Decimal presented as a correctly rounded double (same as Spark's
    cast through text)."""
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def set_sql(x: str) -> str:
    """Sorted distinct non-null values as text joined by ';' (export form)."""
    return (
        f"coalesce(array_to_string(list_sort(list_transform("
        f"array_agg(DISTINCT {x}) FILTER (WHERE {x} IS NOT NULL), lambda v: CAST(v AS VARCHAR))), ';'), '')"
    )


def avg_sql(x: str) -> str:
    """Exact half-even average in cents (mirror of ``avg_half_even``)."""
    c = f"CAST(sum({x}) * 100 AS HUGEINT)"
    n = f"count({x})"
    a = f"abs({c})"
    quot = f"({a} // {n})"
    rem = f"({a} % {n})"
    bump = f"CASE WHEN 2 * {rem} > {n} OR (2 * {rem} = {n} AND {quot} % 2 = 1) THEN 1 ELSE 0 END"
    mag = f"({quot} + {bump})"
    signed = f"CASE WHEN {c} < 0 THEN -{mag} ELSE {mag} END"
    return (
        f"CASE WHEN {n} = 0 THEN NULL ELSE "
        f"CAST(CAST({signed} AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) END"
    )


def measures_sql(recipients: bool = True) -> str:
    out = ["count(*) AS total_payments"]
    if recipients:
        out.append("count(DISTINCT recipient_id) AS total_recipients")
    out += [
        f"{num('CAST(sum(amount) AS DECIMAL(28,2))')} AS amount_sum",
        f"{num(avg_sql('amount'))} AS amount_avg",
        f"{num('max(amount)')} AS amount_max",
        f"{num('min(amount)')} AS amount_min",
    ]
    return ", ".join(out)


def _star_sql() -> str:
    return (
        "lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
        "JOIN customer c ON o.o_custkey = c.c_custkey "
        "JOIN nation n ON c.c_nationkey = n.n_nationkey "
        "JOIN region r ON n.n_regionkey = r.r_regionkey "
        "JOIN part p ON l.l_partkey = p.p_partkey"
    )


def payments_cte() -> str:
    """``payments`` view over the driver tables, same rules as
    ``testdata.payments``."""
    country = country_sql("c.c_nationkey")
    geo = f"c.c_mktsegment <> {q(NO_ADDRESS_SEGMENT)}"
    scheme = f"CASE WHEN p.p_size >= {MIN_SCHEME_SIZE} THEN concat_ws(' ', p.p_type, p.p_brand) END"
    amount = "CAST(l.l_extendedprice AS DECIMAL(18,2))"
    return f"""payments AS (
  SELECT
    {entity_id_sql('l.l_orderkey', 'l.l_linenumber')} AS pk,
    {country} AS country,
    CAST(year(l.l_shipdate) + {YEAR_SHIFT} AS INTEGER) AS year,
    {entity_id_sql('c.c_custkey')} AS recipient_id,
    c.c_name AS recipient_name,
    {fingerprint_sql('c.c_name')} AS recipient_fingerprint,
    CASE WHEN {geo} THEN concat_ws(', ', c.c_mktsegment, {country}) END AS recipient_address,
    {country} AS recipient_country,
    CAST(NULL AS VARCHAR) AS recipient_url,
    {scheme_id_sql(scheme)} AS scheme_id,
    {scheme} AS scheme,
    CAST(NULL AS VARCHAR) AS scheme_code,
    CAST(NULL AS VARCHAR) AS scheme_description,
    {amount} AS amount,
    'EUR' AS currency,
    {amount} AS amount_original,
    'EUR' AS currency_original,
    CASE WHEN {geo} THEN r.r_name END AS nuts1,
    CASE WHEN {geo} THEN {country} END AS nuts2,
    CASE WHEN {geo} THEN concat_ws('-', {country}, c.c_mktsegment) END AS nuts3
  FROM {_star_sql()}
)"""


def with_payments(body: str) -> str:
    return f"WITH {payments_cte()}\n{body}"



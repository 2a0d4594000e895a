"""DuckDB SQL mirror of the cleaning functions and pipeline, for the
correctness oracle only. Each helper mirrors the Spark expression of the same
name in ``cropledger.functions`` / ``cropledger.operators``."""

from __future__ import annotations

from cropledger.dims import (
    COUNTRIES,
    COUNTRY_CURRENCY,
    CURRENCIES,
    EMPTY_MARKERS,
    NATION_COUNTRY,
    NULL_TOKENS,
)
from cropledger.functions.text import CELL_STRIP, WHITESPACE
from cropledger.operators.clean import ADDRESS_PARTS, ALTERNATIVES
from cropledger.operators.lookups import rate_decimals, scheme_full_names, scheme_id_pattern
from cropledger.plans.oracle import _star_sql, country_sql, entity_id_sql, fingerprint_sql, normalize_scheme_sql, q
from cropledger.plans.testdata import (
    FOREIGN,
    LOCAL,
    MIN_SCHEME_SIZE,
    PLACEHOLDER_NAMES,
    RATE_COUNTRIES,
    RAW_SCHEME_IDS,
    YEAR_SHIFT,
)
from cropledger.schema import RAW_COLUMNS, YEAR_MAX, YEAR_MIN


def _case(x: str, pairs, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {v}" for k, v in pairs)
    return f"CASE {x} {whens} ELSE {default} END"


def null_token_sql(x: str) -> str:
    return f"CASE WHEN {x} IN ({', '.join(q(t) for t in NULL_TOKENS)}) THEN NULL ELSE {x} END"


def trim_cell_sql(x: str) -> str:
    ws = " || ".join(f"chr({ord(ch)})" for ch in WHITESPACE)
    return f"trim(trim({x}, {q(CELL_STRIP)}), {ws})"


def has_fp_sql(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '[\\p{{L}}\\p{{N}}]'), false)"


def usable_sql(x: str) -> str:
    markers = " AND ".join(f"NOT contains(lower({x}), {q(m)})" for m in EMPTY_MARKERS)
    return f"coalesce({x} IS NOT NULL AND {x} <> '' AND {markers} AND {has_fp_sql(x)}, false)"


def collapse_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def country_code_sql(x: str) -> str:
    codes = ", ".join(q(c) for c, _n, _x in COUNTRIES)
    aliases = {}
    for code, name, native in COUNTRIES:
        for alias in (name, native):
            aliases[alias.lower()] = code
    # of the countries beyond the served ones the raw view names these only
    codes += ", 'CH', 'US'"
    aliases |= {"united states": "US", "switzerland": "CH", "el": "GR", "uk": "GB"}
    by_name = _case(f"lower(trim({x}))", [(k, q(v)) for k, v in sorted(aliases.items())])
    return f"CASE WHEN upper(trim({x})) IN ({codes}) THEN upper(trim({x})) ELSE {by_name} END"


def country_name_sql(x: str) -> str:
    return _case(x, [(c, q(n)) for c, n, _ in [*COUNTRIES, ("CH", "Switzerland", ""), ("US", "United States", "")]])


def national_currency_sql(x: str) -> str:
    return _case(x, [(k, q(v)) for k, v in COUNTRY_CURRENCY.items()])


def rate_sql(cur: str, year: str) -> str:
    pairs = [(k, f"CAST({q(str(v))} AS DECIMAL(12,10))") for k, v in rate_decimals().items()]
    return _case(f"concat_ws('|', {cur}, CAST({year} AS VARCHAR))", pairs)


def parse_amount_sql(x: str) -> str:
    return (
        f"CASE WHEN contains({x}, ',') AND length(string_split({x}, ',')[-1]) > 2 THEN NULL "
        f"ELSE TRY_CAST(replace({x}, ',', '.') AS DECIMAL(24,6)) END"
    )


def to_amount_sql(x: str) -> str:
    return f"TRY_CAST({x} AS DECIMAL(18,2))"


def guess_scheme_sql(x: str) -> str:
    names = scheme_full_names()
    matched = f"regexp_extract({x}, {q(scheme_id_pattern())}, 1)"
    by_id = f"CASE WHEN {matched} <> '' THEN {_case(f'lower({matched})', [(i.lower(), q(f)) for i, _n, f in names])} END"
    whens = " ".join(
        f"WHEN contains({q(n.lower())}, lower({x})) THEN {q(f)}" for _i, n, f in names if n is not None
    )
    return f"coalesce({by_id}, CASE {whens} END, {x})"


def clean_address_sql(full: str, parts: list[str], cc: str) -> str:
    full = f"nullif(trim({full}), '')"
    cparts = [f"nullif(trim({p}), '')" for p in parts]
    from_parts = f"concat_ws(', ', {', '.join(cparts)})"
    extra = [f"CASE WHEN NOT coalesce(contains({full}, {p}), false) THEN {p} END" for p in cparts]
    joined = f"CASE WHEN {full} IS NULL THEN {from_parts} ELSE concat_ws(', ', {full}, {', '.join(extra)}) END"
    suffix = f"(', ' || {cc})"
    stripped = (
        f"CASE WHEN {cc} IS NOT NULL AND ends_with({joined}, {suffix}) "
        f"THEN substring({joined}, 1, length({joined}) - length({suffix})) ELSE {joined} END"
    )
    stripped = f"rtrim({stripped}, ', ')"
    out = f"CASE WHEN {has_fp_sql(stripped)} AND {stripped} IS DISTINCT FROM {cc} THEN {stripped} ELSE {country_name_sql(cc)} END"
    out = f"regexp_replace({out}, '(\\s\\d+)\\.\\d', '\\1', 'g')"
    xp = f"regexp_extract({out}, '.*data=''([\\w.\\s]+)''', 1)"
    return f"CASE WHEN contains({out}, 'xpath') AND {xp} <> '' THEN {xp} ELSE {out} END"


# ---------------------------------------------------------------------------
# raw_payments view (mirror of testdata.raw_payments)
# ---------------------------------------------------------------------------

RAW_PRESENT = [
    "country",
    "year",
    "recipient_name",
    "recipient_id",
    "recipient_street",
    "recipient_location",
    "recipient_postcode",
    "recipient_country",
    "scheme",
    "amount",
    "currency",
]


def raw_payments_cte() -> str:
    country = country_sql("c.c_nationkey")
    natl = national_currency_sql(country)
    price = "CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)"
    comma = f"replace({price}, '.', ',')"
    ok, ck, size = "l.l_orderkey", "c.c_custkey", "p.p_size"
    ids = ", ".join(q(i) for i in RAW_SCHEME_IDS)
    postcode = f"CAST(1000 + {ck} % 900 AS VARCHAR)"
    here = f"{ck} % 4 = 3 AND {country} IN ({', '.join(q(c) for c in LOCAL)})"
    local = [_case(country, [(c, q(texts[i])) for c, texts in LOCAL.items()]) for i in range(3)]
    street_no = f"CAST({ck} % 100 AS VARCHAR)"
    return f"""raw AS (
  SELECT
    CASE WHEN {ck} % 19 = 0 THEN lower({country}) ELSE {country} END AS country,
    CAST(year(l.l_shipdate) + {YEAR_SHIFT} AS VARCHAR) AS year,
    CASE WHEN {ck} % 53 = 0 THEN {q(PLACEHOLDER_NAMES[0])} WHEN {ck} % 59 = 0 THEN {q(PLACEHOLDER_NAMES[1])}
         WHEN {ck} % 61 = 0 THEN {q(PLACEHOLDER_NAMES[2])}
         WHEN {here} THEN {local[0]} || ' ' || {ck}
         WHEN {ck} % 7 = 0 THEN '" ' || c.c_name || '  ",'
         WHEN {ck} % 5 = 0 THEN replace(c.c_name, '#', '  #  ')
         ELSE c.c_name END AS recipient_name,
    CASE WHEN {ck} % 2 = 0 THEN CAST({ck} AS VARCHAR) END AS recipient_id,
    CASE WHEN {ck} % 17 = 0 THEN 'xpath /a data=''Street ' || {street_no} || ''''
         ELSE 'Street ' || {street_no} END AS recipient_street,
    CASE WHEN {here} THEN {local[1]} ELSE c.c_mktsegment END AS recipient_location,
    CASE WHEN {ck} % 13 = 0 THEN {postcode} || '.0' ELSE {postcode} END AS recipient_postcode,
    CASE WHEN {ck} % 11 = 0 THEN '' {' '.join(f"WHEN {ck} % {n} = 0 THEN {q(t)}" for n, t in FOREIGN.items())}
         WHEN {ck} % 3 = 0 THEN lower({country}) ELSE {country} END AS recipient_country,
    CASE WHEN {size} < {MIN_SCHEME_SIZE} THEN ''
         WHEN {size} % 5 = 0 THEN list_value({ids})[{size} % 3 + 1] || ' ' || p.p_type
         WHEN {size} % 5 = 1 THEN lower(p.p_type)
         WHEN {here} AND {size} % 5 = 2 THEN {local[2]}
         ELSE p.p_type || ' ' || p.p_brand END AS scheme,
    CASE WHEN {ok} % 97 = 0 THEN '1.' || {comma} WHEN {ok} % 89 = 0 THEN ''
         WHEN {ok} % 2 = 1 THEN {comma} ELSE {price} END AS amount,
    CASE WHEN {ok} % 101 = 0 THEN 'XXX' WHEN {country} IN ({', '.join(q(c) for c in RATE_COUNTRIES)}) THEN {natl} ELSE 'EUR' END AS currency,
    CAST({ok} * 100 + l.l_linenumber AS BIGINT) AS _row
  FROM {_star_sql()}
)"""


# ---------------------------------------------------------------------------
# clean() pipeline over the raw view (no options, no geocode)
# ---------------------------------------------------------------------------

ERR_STRUCT = "STRUCT(code VARCHAR, value VARCHAR)"


def _err(cond: str, code: str, value: str) -> str:
    return f"CASE WHEN {cond} THEN {{'code': {q(code)}, 'value': CAST({value} AS VARCHAR)}}::{ERR_STRUCT} END"


def clean_ctes(present=RAW_PRESENT) -> str:
    """CTE chain ``raw → c1 … c6 → cleaned`` equal to ``clean(raw).cleaned``
    (``_file`` null, ``_row`` from the raw view)."""
    col = {c: (c if c in present else "CAST(NULL AS VARCHAR)") for c in RAW_COLUMNS}
    has_rc = "recipient_country" in present
    has_cur = "currency" in present
    c1 = ", ".join(f"{null_token_sql(col[c])} AS {c}" for c in RAW_COLUMNS)
    c2 = ", ".join(f"nullif({trim_cell_sql(c)}, '') AS {c}" for c in RAW_COLUMNS)
    anon = "sha1(concat_ws(chr(31), '', coalesce(CAST(_row AS VARCHAR), ''), " + ", ".join(f"coalesce({c}, '')" for c in RAW_COLUMNS) + "))"
    alts = {g[0]: "coalesce(" + ", ".join(f"CASE WHEN {usable_sql(c)} THEN {c} END" for c in g) + ")" for g in ALTERNATIVES}
    c3_cols = [f"{alts.get(c, c)} AS {c}" for c in RAW_COLUMNS]
    # c4: country code, name, fingerprint inputs
    name = (
        f"CASE WHEN {usable_sql('recipient_name')} THEN {collapse_sql('recipient_name')} "
        f"WHEN {has_fp_sql('recipient_id')} THEN concat_ws(' ', {country_code_sql('country')}, recipient_id) "
        f"ELSE 'Anonymous ' || substring(_anon, 1, 22) END"
    )
    cur = "currency" if has_cur else "CAST(NULL AS VARCHAR)"
    rc = (
        f"CASE WHEN recipient_country IS NULL THEN country_c ELSE {country_code_sql('recipient_country')} END"
        if has_rc
        else "country_c"
    )
    parts = [("recipient_country_c" if p == "recipient_country" else p) for p in ADDRESS_PARTS]
    joined_scheme = "nullif(trim(concat_ws(' ', scheme_name, scheme_1, scheme_2)), '')"
    s_text = collapse_sql(f"coalesce(scheme, {joined_scheme})")
    served = ", ".join(q(c) for c, _n, _x in COUNTRIES)
    currencies = ", ".join(q(c) for c in CURRENCIES)
    rc_err = _err("rc_raw IS NOT NULL AND recipient_country_c IS NULL", "InvalidCountry", "rc_raw") if has_rc else f"CAST(NULL AS {ERR_STRUCT})"
    errors = (
        "list_filter(["
        + ", ".join(
            [
                _err("country_c IS NULL", "InvalidCountry", "country"),
                rc_err,
                _err(f"NOT coalesce(eff_cur IN ({currencies}), false)", "InvalidCurrency", "eff_cur"),
                _err("amount_original IS NULL", "InvalidAmount", "amount"),
                _err(
                    "amount_original IS NOT NULL AND NOT (eff_cur = 'EUR') AND natl IS NULL AND country_c IS NOT NULL",
                    "InvalidCountry",
                    "country_c",
                ),
                _err(
                    "amount_original IS NOT NULL AND NOT (eff_cur = 'EUR') AND natl IS NOT NULL AND rate IS NULL",
                    "InvalidCurrency",
                    "'No currency conversion for `' || natl || '|' || CAST(year_i AS VARCHAR) || '`'",
                ),
            ]
        )
        + "], lambda e: e IS NOT NULL)"
    )
    order_by = "_file NULLS FIRST, _row NULLS FIRST, _anon NULLS FIRST"
    return f"""{raw_payments_cte()},
c1 AS (SELECT {c1}, CAST(NULL AS VARCHAR) AS _file, _row FROM raw),
c2 AS (SELECT {c2}, _file, _row FROM c1
       WHERE NOT (recipient_name IS NOT DISTINCT FROM 'recipient_name')
         AND NOT (denumire_beneficiar IS NOT DISTINCT FROM 'denumire_beneficiar')),
c3 AS (SELECT {', '.join(c3_cols)}, _file, _row, {anon} AS _anon FROM c2),
c4 AS (SELECT *, {country_code_sql('country')} AS country_c, {name} AS name_c,
              TRY_CAST(year AS INTEGER) AS year_i, {cur} AS cur_orig
       FROM c3),
c5 AS (SELECT *, {fingerprint_sql('name_c')} AS fp_c,
              coalesce(cur_orig, {national_currency_sql('country_c')}) AS eff_cur,
              {national_currency_sql('country_c')} AS natl,
              {parse_amount_sql('amount')} AS parsed,
              {rc} AS recipient_country_c,
              recipient_country AS rc_raw
       FROM c4),
c6 AS (SELECT *, {rate_sql('natl', 'year_i')} AS rate,
              {to_amount_sql('parsed')} AS amount_original,
              {clean_address_sql('recipient_address', parts, 'recipient_country_c')} AS address_c,
              CASE WHEN {has_fp_sql(s_text)} THEN {guess_scheme_sql(s_text)} END AS scheme_c
       FROM c5),
c7 AS (SELECT *, {to_amount_sql("CASE WHEN eff_cur = 'EUR' THEN parsed ELSE parsed * rate END")} AS amount_c,
              {entity_id_sql('recipient_country_c', 'fp_c', f"coalesce({fingerprint_sql('address_c')}, _anon)")} AS recipient_id_c,
              {entity_id_sql(normalize_scheme_sql('scheme_c'))} AS scheme_id_c,
              {errors} AS errors
       FROM c6),
c8 AS (SELECT {entity_id_sql('year_i', 'country_c', 'recipient_id_c', 'scheme_id_c', 'amount_c')} AS pk,
              country_c AS country, year_i AS year, recipient_id_c AS recipient_id, name_c AS recipient_name,
              fp_c AS recipient_fingerprint, address_c AS recipient_address, recipient_country_c AS recipient_country,
              recipient_url, scheme_id_c AS scheme_id, scheme_c AS scheme, CAST(NULL AS VARCHAR) AS scheme_code,
              scheme_description, amount_c AS amount, 'EUR' AS currency, amount_original,
              cur_orig AS currency_original, CAST(NULL AS VARCHAR) AS nuts1, CAST(NULL AS VARCHAR) AS nuts2,
              CAST(NULL AS VARCHAR) AS nuts3, _file, _row, _anon, errors
       FROM c7),
c9 AS (SELECT *, coalesce(pk IS NOT NULL AND country IN ({served}) AND year BETWEEN {YEAR_MIN} AND {YEAR_MAX}
                          AND recipient_id IS NOT NULL AND recipient_country IS NOT NULL
                          AND (currency_original IS NULL OR currency_original IN ({currencies})), false) AS _valid
       FROM c8),
cleaned AS (SELECT * EXCLUDE (_rn, _anon) FROM (
       SELECT *, row_number() OVER (PARTITION BY pk ORDER BY {order_by}) AS _rn FROM c9) WHERE _rn = 1)"""


def clean_sql(body: str, present=RAW_PRESENT) -> str:
    return f"WITH {clean_ctes(present)}\n{body}"


__all__ = [
    "NATION_COUNTRY",
    "clean_sql",
    "raw_payments_cte",
]

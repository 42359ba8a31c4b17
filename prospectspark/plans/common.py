"""Registration of queries and pieces of SQL that several oracles use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import config
from ..sources.fixtures import chain

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
        """Register a query.  sql: a select, or further ``with`` clauses and a select, over the views."""

        def register(f: Query) -> Query:
            self.queries[name] = f
            if sql is not None:
                text = sql.strip()
                if views:
                    text = chain(*views) + (",\n" + text[5:] if text.lower().startswith("with ") else "\n" + text)
                self.sql[name] = text
            return f

        return register

    def alias(self, second: str, name: str) -> None:
        """A second name of a query."""
        self.queries[second] = self.queries[name]
        self.sql[second] = self.sql[name]


def sql_norm_ws(c: str) -> str:
    return rf"trim(regexp_replace(replace(lower(coalesce({c}, '')), chr(160), ' '), '\s+', ' ', 'g'))"


def sql_fold(c: str) -> str:
    return f"regexp_replace(strip_accents({c}), '[^\\x00-\\x7F]', '', 'g')"


def sql_norm_text(c: str) -> str:
    return f"trim(regexp_replace({sql_fold(f"replace(lower(coalesce({c}, '')), 'ß', 'ss')")}, '[^a-z0-9]+', ' ', 'g'))"


def sql_norm_company(c: str) -> str:
    out = f"' ' || {sql_norm_text(c)} || ' '"
    for phrase in config.LEGAL_PHRASES:
        out = f"replace({out}, ' {phrase} ', ' ')"
    return f"trim({out})"


def sql_norm_posting(c: str) -> str:
    return rf"lower(trim(regexp_replace({sql_fold(f"replace(coalesce({c}, ''), 'ß', '')")}, '\s+', ' ', 'g')))"


def sql_legacy(c: str) -> str:
    out = sql_fold(f"replace(lower(coalesce({c}, '')), 'ß', '')")
    for part in config.LEGACY_SUBSTRINGS:
        out = f"replace({out}, '{part}', ' ')"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


def sql_list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def sql_any(text: str, terms) -> str:
    return f"(len(list_filter({sql_list(t.lower() for t in terms)}, lambda t: contains(lower(coalesce({text}, '')), t))) > 0)"


def sql_first(text: str, terms) -> str:
    return f"(list_filter({sql_list(terms)}, lambda t: contains(lower(coalesce({text}, '')), lower(t)))[1])"


def sql_wz2(c: str) -> str:
    return rf"regexp_extract(coalesce({c}, ''), '^\s*(\d{{2}})', 1)"


def sql_wz_code(c: str) -> str:
    return rf"regexp_extract(coalesce({c}, ''), '^\s*(\d{{2}}(?:\.\d+)*)', 1)"


def sql_number(c: str) -> str:
    bare = f"regexp_replace(trim({c}), '[ €% ]', '', 'g')"
    digits = f"replace(replace(regexp_replace({bare}, '^[+-]+', ''), '.', ''), ',', '.')"
    if_comma = f"case when contains({bare}, ',') then {digits} else replace(regexp_replace({bare}, '^[+-]+', ''), '.', '') end"
    nulls = ", ".join(f"'{t}'" for t in config.NULL_TOKENS)
    return (
        rf"case when lower(trim({c})) in ({nulls}) or not regexp_full_match({if_comma}, '(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') then null "
        f"when starts_with({bare}, '-') then -try_cast({if_comma} as double) else try_cast({if_comma} as double) end"
    )


def sql_bare(name: str, place: str) -> str:
    """The name without the place's tokens."""
    return f"coalesce(nullif(array_to_string(list_filter(string_split({name}, ' '), lambda t: not list_contains(string_split({place}, ' '), t)), ' '), ''), {name})"


def sql_subset(a: str, b: str) -> str:
    """Whether the tokens of one are some, not all, of the other's."""
    x, y = (f"list_distinct(string_split({n}, ' '))" for n in (a, b))
    return f"(len({x}) <> len({y}) and len(list_intersect({x}, {y})) = least(len({x}), len({y})))"


def sql_ratio(pairs: str) -> str:
    """A chain of tables that ends with ratio(a, b, score) of the different pairs of ``pairs``.

    The longest common subsequence is a fold over the characters of one name; the state is a number with a bit for each character of the other.
    """
    tokens = lambda n: f"list_sort(list_distinct(list_filter(string_split({n}, ' '), lambda w: w <> '')))"
    part = lambda own, other, has: f"array_to_string(list_filter({own}, lambda w: {has} list_contains({other}, w)), ' ')"
    short = lambda n: f"case when s <> '' then 100.0::double - 100.0::double * (1 + length({n})) / (2 * length(s) + 1 + length({n})) end"
    return f"""r1 as (select distinct a, b, {tokens('a')} as x, {tokens('b')} as y from {pairs}),
    r2 as (select a, b, x, y, {part('x', 'y', '')} as s, {part('x', 'y', 'not')} as p, {part('y', 'x', 'not')} as q from r1),
    r3 as (select *, ((1::hugeint << length(p)) - 1)::hugeint as f, list_transform(string_split(q, ''),
      lambda c: coalesce(list_sum(list_transform(range(length(p)), lambda i: case when substr(p, i + 1, 1) = c then 1::hugeint << i else 0::hugeint end)), 0)::hugeint) as hits from r2),
    r4 as (select *, list_reduce(hits, lambda z, m: ((z + (z & m)) | (z - (z & m))) & f, f) as z from r3),
    r5 as (select *, length(p) + length(q) - 2 * case when p = '' or q = '' then 0 else length(p) - bit_count(z) end as edits from r4),
    ratio as (select a, b, case when len(x) = 0 or len(y) = 0 then 0.0::double when s <> '' and (p = '' or q = '') then 100.0::double
      else greatest(100.0::double - 100.0::double * edits / (2 * (length(s) + (s <> '')::int) + length(p) + length(q)), {short('p')}, {short('q')}) end as score from r5)"""


def sql_one_decimal(c: str) -> str:
    return f"cast(printf('%.1f', {c}) as double)"

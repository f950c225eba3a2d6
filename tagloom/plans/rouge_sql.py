"""Oracles of the stemmed scores: Porter's steps as CASE rules over distinct words, and subsequences by sweeping one row of the table at a time."""

from __future__ import annotations

from ..functions.similarity import STEP2, STEP3, STEP4


def _marked(x: str) -> str:
    """Each y that is a vowel as I: one behind a consonant. A y at the start is none."""
    return rf"regexp_replace(regexp_replace({x}, '^y', 'Q'), '([^aeiouy])y', '\1I', 'g')"


def _form(x: str) -> str:
    """A word as runs of consonants (C) and vowels (V)."""
    return f"regexp_replace(regexp_replace({_marked(x)}, '[aeiouI]+', 'V', 'g'), '[^V]+', 'C', 'g')"


def _measure(x: str) -> str:
    return f"((length({_form(x)}) - length(replace({_form(x)}, 'VC', ''))) // 2)"


def _vowel(x: str) -> str:
    return f"contains({_form(x)}, 'V')"


def _short(x: str) -> str:
    return f"regexp_matches({_marked(x)}, '[^aeiouI][aeiouI][^aeiouIwxy]$')"


def _but(x: str, n: int) -> str:
    return f"left({x}, length({x}) - {n})"


def _rules(rules: dict[str, str]) -> str:
    whens = (f"when suffix(x, '{s}') then case when {_measure(_but('x', len(s)))} > 0 then {_but('x', len(s))} || '{rules[s]}' else x end" for s in sorted(rules, key=len, reverse=True))
    return f"case {' '.join(whens)} else x end"


def _removals() -> str:
    also = {"ion": f" and right({_but('x', 3)}, 1) in ('s', 't')"}
    whens = (f"when suffix(x, '{s}') then case when {_measure(_but('x', len(s)))} > 1{also.get(s, '')} then {_but('x', len(s))} else x end" for s in sorted(STEP4, key=len, reverse=True))
    return f"case {' '.join(whens)} else x end"


_STEPS = (
    f"case when suffix(x, 'sses') or suffix(x, 'ies') then {_but('x', 2)} when suffix(x, 's') and not suffix(x, 'ss') then {_but('x', 1)} else x end",
    f"case when suffix(x, 'eed') then case when {_measure(_but('x', 3))} > 0 then {_but('x', 1)} else x end "
    f"when suffix(x, 'ed') and {_vowel(_but('x', 2))} then {_but('x', 2)} || '+' when suffix(x, 'ing') and {_vowel(_but('x', 3))} then {_but('x', 3)} || '+' else x end",
    f"case when not suffix(x, '+') then x when regexp_matches(x, '(at|bl|iz)[+]$') then {_but('x', 1)} || 'e' "
    f"when length(x) > 2 and substr(x, -2, 1) = substr(x, -3, 1) and substr(x, -2, 1) not in ('a', 'e', 'i', 'o', 'u', 'l', 's', 'z') then {_but('x', 2)} "
    f"when {_measure(_but('x', 1))} = 1 and {_short(_but('x', 1))} then {_but('x', 1)} || 'e' else {_but('x', 1)} end",
    f"case when suffix(x, 'y') and {_vowel(_but('x', 1))} then {_but('x', 1)} || 'i' else x end",
    _rules(STEP2),
    _rules(STEP3),
    _removals(),
    f"case when suffix(x, 'e') and ({_measure(_but('x', 1))} > 1 or {_measure(_but('x', 1))} = 1 and not {_short(_but('x', 1))}) then {_but('x', 1)} else x end",
    f"case when suffix(x, 'll') and {_measure('x')} > 1 then {_but('x', 1)} else x end",
)


def scores(pairs: str, sides: tuple[str, ...]) -> str:
    """CTEs that end with rouge(k, side, rouge1, rouge2, rougel): stemmed F1 of each side of ``pairs`` (a query with k, reference and the sides) with the reference."""
    words = lambda c: f"regexp_extract_all(lower({c}), '[a-z0-9]+')"
    texts = " union all ".join(f"select k, '{s}' as side, {words(s)} as a, {words('reference')} as b from pairs_" for s in sides)
    steps, before = [], "select w, w as x from (select distinct unnest(list_concat(a, b)) as w from texts_) where length(w) > 3"
    for i, step in enumerate(_STEPS):
        steps.append(f"stem{i} as ({before})")
        before = f"select w, {step} as x from stem{i}"
    grams = "union all ".join(f"select k, side, {n} as n, string_agg(w, ' ' order by j) as g, i from (select k, side, i - d as i, w, i as j from {{0}}, range({n}) t(d)) where i >= 0 group by k, side, i having count(*) = {n} " for n in (1, 2))
    return f"""pairs_ as ({pairs}), texts_ as ({texts}), {", ".join(steps)}, stems as ({before}),
sa as materialized (select k, side, i, coalesce(x, a.w) as w from (select k, side, unnest(a) as w, unnest(range(len(a))) as i from texts_) a left join stems using (w)),
sb as materialized (select k, side, i, coalesce(x, b.w) as w from (select k, side, unnest(b) as w, unnest(range(len(b))) as i from texts_) b left join stems using (w)),
ga as (select k, side, n, g, count(*) as c from ({grams.format("sa")}) group by all), gb as (select k, side, n, g, count(*) as c from ({grams.format("sb")}) group by all),
both_ as (select k, side, n, sum(least(ga.c, gb.c)) as c from ga join gb using (k, side, n, g) group by all),
f as (select k, side, n, case when c is null then 0.0 else 2.0 * c / (greatest(len(a) - n + 1, 0) + greatest(len(b) - n + 1, 0)) end as f1 from texts_ cross join (values (1), (2)) v(n) left join both_ using (k, side, n)),
sweep(k, side, step, j, v) as (select k, side, 0::bigint, i, 0::bigint from sb union all
  select k, side, step + 1, j, max(c) over (partition by k, side order by j) from (
    select s.k, s.side, s.step, s.j, case when sa.w = sb.w then coalesce(lag(s.v) over (partition by s.k, s.side order by s.j), 0) + 1 else s.v end as c
    from sweep s join sa on sa.k = s.k and sa.side = s.side and sa.i = s.step join sb on sb.k = s.k and sb.side = s.side and sb.i = s.j)),
longest as (select k, side, max(v) as v from sweep group by k, side),
rouge as (select k, side, cast(max(f1) filter (n = 1) as double) as rouge1, cast(max(f1) filter (n = 2) as double) as rouge2,
  cast(any_value(case when coalesce(v, 0) = 0 then 0.0 else 2.0 * v / (len(a) + len(b)) end) as double) as rougel from f join texts_ using (k, side) left join longest using (k, side) group by k, side)"""

"""Scalar rules over text, names and labels, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hygiene import NO_ABSTRACT
from .text import ustrip


def clean_abstract(abstract: Column, longest: int = 1500) -> Column:
    """Stripped and cut to ``longest`` characters for display; null and the stand-in for a missing abstract become empty."""
    bare = ustrip(F.coalesce(abstract, F.lit("")))
    return F.when(F.lower(bare) == NO_ABSTRACT, "").otherwise(F.substring(bare, 1, longest))


def embedding_text(title: Column, abstract: Column, status: Column) -> Column:
    """Title and abstract of papers that are ``ok``, the title of ``title_only`` ones, else null."""
    return F.when(status == "ok", F.concat(ustrip(title), F.lit("\n\n"), ustrip(abstract))).when(status == "title_only", ustrip(title))


#: Patterns of titles from fields outside the taxonomy; any match counts.
OUT_OF_SCOPE = (
    r"\bphysics\b", r"\bastro", r"\bastronomy\b", r"\bastrophysic",
    r"\bcosmolog", r"\bnuclear\b", r"\bnucle(i|us|on)", r"\batomic\b",
    r"\bquantum field", r"\bqcd\b", r"\bqed\b", r"\bparticle physics\b",
    r"\bhiggs\b", r"\bboson\b", r"\bhadron", r"\bquark", r"\blepton",
    r"\bneutrino", r"\bgluon", r"\bmuon", r"\bfermion",
    r"\bgravitation", r"\bgravitational wave", r"\bblack hole",
    r"\bgalax(y|ies)\b", r"\bstellar\b", r"\bplasma\b",
    r"\bspacetime\b", r"\brelativit", r"\bcondensed matter\b",
    r"\bstring theory\b", r"\bdark matter\b", r"\bdark energy\b",
)


def out_of_scope(title: Column) -> Column:
    """Whether a title looks like one from outside the taxonomy; a null title does not."""
    return F.coalesce(title.rlike("(?i)(?:" + "|".join(OUT_OF_SCOPE) + ")"), F.lit(False))


def prompt_text(title: Column, abstract: Column, longest: int, *, before: str = "Title: ", between: str = "\n\nAbstract: ", missing: str = "\n\n(No abstract available.)") -> Column:
    """Title and the first ``longest`` characters of the abstract, with a stand-in where that is null or empty."""
    body = F.when(F.coalesce(abstract, F.lit("")) != "", F.concat(F.lit(between), F.substring(abstract, 1, longest))).otherwise(F.lit(missing))
    return F.concat(F.lit(before), F.coalesce(title, F.lit("")), body)


def json_object(text: Column) -> Column:
    """The JSON object inside prose: within a fence if there is one, from the first ``{`` to the last ``}``; else null."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    body = F.when(fenced != "", fenced).otherwise(text)
    found = F.regexp_extract(body, r"(?s)(\{.*\})", 1)
    return F.nullif(found, F.lit(""))


def any_contains(text: Column, words: list[str]) -> Column:
    """Whether the text holds one of the words, as they are."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def keyword_hits(text: Column, groups: dict[str, str]) -> Column:
    """Names of the pattern groups that the text matches, in the order given."""
    return F.array_compact(F.array(*[F.when(text.rlike(pattern), name) for name, pattern in groups.items()]))


def compact_scope(text: Column, decision: str) -> Column:
    """The first sentence and those that match ``decision``; sentences end with a full stop or semicolon."""
    parts = F.split(text, r"(?<=[.;])\s+")
    return F.array_join(F.filter(parts, lambda s, i: (i == 0) | s.rlike(decision)), " ")


def slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.replace(F.lower(name), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def first_digit_name(answer: Column, names: list[str]) -> Column:
    """The name that the first digit of an answer stands for, from 1; null for 0, other digits or none."""
    digit = F.nullif(F.regexp_extract(answer, "[0-9]", 0), F.lit("")).cast("int")
    return F.when((digit >= 1) & (digit <= len(names)), F.element_at(F.array(*map(F.lit, names)), F.greatest(digit, F.lit(1))))


def estimated_tokens(text: Column) -> Column:
    return F.greatest(F.lit(16), F.floor(F.length(text) / 4)).cast("int")


def display_name(*parts: Column, otherwise: str) -> Column:
    """Non-empty parts with spaces between."""
    bare = [F.nullif(ustrip(F.coalesce(p, F.lit(""))), F.lit("")) for p in parts]
    return F.coalesce(F.nullif(F.concat_ws(" ", *bare), F.lit("")), F.lit(otherwise))


def shown(text: Column, longest: int) -> Column:
    return F.when(F.length(text) > longest, F.concat(F.substring(text, 1, longest), F.lit("..."))).otherwise(text)


def agreement(a: Column, b: Column, comparable: Column) -> Column:
    """Whether two labels are equal; null where they cannot be compared."""
    return F.when(comparable, a.eqNullSafe(b))


def blind_flip(seed: str, key: Column) -> Column:
    """A fair coin per key, the same in every run and engine: the parity of the last hexadecimal digit of an MD5 hash."""
    return F.instr(F.lit("13579bdf"), F.right(F.md5(F.concat(F.lit(seed + "-"), key)), F.lit(1))) > 0


def clamped(value: Column, allowed: list[str], otherwise: str) -> Column:
    return F.when(value.isin(*allowed), value).otherwise(otherwise)

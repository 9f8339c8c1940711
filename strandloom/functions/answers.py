"""Parsers of answers: what counts as an answer, and what is rejected (null)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandloom.functions import text as X

MOST_NAMES, MOST_WORDS = 8, 8


def named_prerequisites(answer: Column) -> Column:
    """The names of ``{"prereqs": [...]}``, each once, at most eight; an empty list for none; null for anything else.

    A name may itself be a list; a name of more than eight words, or one that
    makes no slug (no Latin letter and no digit), rejects the whole answer.
    """
    parsed = F.from_json(answer, "prereqs array<string>", {"mode": "PERMISSIVE"})
    raw = F.get_json_object(answer, "$.prereqs")
    # members that are no text come through as text: the raw members tell
    plain = raw.rlike(r'(?s)^\[\s*("([^"\\]|\\.)*"\s*(,\s*"([^"\\]|\\.)*"\s*)*)?\]\z')
    parts = F.flatten(F.transform(parsed["prereqs"], lambda n: F.split(n, r"[;\t\r\n]")))
    names = F.array_distinct(F.filter(F.transform(parts, X.trim), lambda n: (n != "") & (F.lower(n) != "none")))
    sound = F.forall(names, lambda n: (F.size(F.split(n, r"\s+")) <= MOST_WORDS) & n.rlike(r"[\p{IsLatin}\p{Nd}]"))
    return F.when(plain & sound, F.slice(names, 1, MOST_NAMES))


def snapped(answer: Column, candidates: Column) -> Column:
    """The candidate that ``{"match": "3"}`` names by its number, ``none`` for none; null for anything else."""
    match = F.get_json_object(answer, "$.match")
    quoted = answer.rlike(r'"match"\s*:\s*"')
    number = F.when(quoted & match.rlike(r"^[1-9]\d?\z"), match.cast("int"))
    return F.when(quoted & (match == "none"), F.lit("none")).when(number <= F.size(candidates), F.get(candidates, number - 1))

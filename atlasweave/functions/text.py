"""Standardising names and separating types from names, as native column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters without an ASCII base that become several letters, and common typographic signs.
EXPANSIONS = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th", "…": "...", "€": "EUR"}
SINGLE = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "ı": "i", "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", " ": " "}


def _accented() -> tuple[str, str]:
    """Latin letters with a mark and the ASCII letters they are built on."""
    source, target = "", ""
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            source, target = source + chr(code), target + base
    for a, b in SINGLE.items():
        source, target = source + a, target + b
    return source, target


_ACCENTED, _PLAIN = _accented()


#: A private-use character that stands in no name.
MARK = "\uf8ff"


def java_literal(text: str) -> str:
    """``text`` as a regular expression that matches it."""
    return re.sub(r"([\\^$.|?*+()\[\]{}])", r"\\\1", text)


def replacement(text: str) -> str:
    """``text`` as a replacement that inserts it."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def transliterate(c: Column) -> Column:
    """ASCII form of Latin text; characters without one are dropped."""
    c = F.translate(c, _ACCENTED, _PLAIN)
    for a, b in EXPANSIONS.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def title_case(c: Column) -> Column:
    """Every letter after a non-letter upper, every other one lower: ``john's 3rd`` is ``John'S 3Rd``."""
    # a space after every non-letter tells initcap; the mark before it, which finds it again, is none of the text's
    spaced = F.regexp_replace(F.translate(c, MARK, "\u0001"), "([^a-zA-Z])", f"$1{MARK} ")
    return F.replace(F.initcap(spaced), F.lit(f"{MARK} "), F.lit(""))


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, r"\s+", " "), "^ | $", "")


def preclean(c: Column, remove_accent: bool = True) -> Column:
    """The standard form of a name; null becomes ''. Not idempotent: a hyphen turns into the space
    that lets a second pass read what follows as a Roman numeral."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    if remove_accent:
        c = transliterate(c)
    # a pattern rather than a case: c is written once, so a chain of steps doesn't double
    c = title_case(F.regexp_replace(c, r"\A&\z", "and"))
    for pattern, by in ((r" And\b", " and"), (r"`S\b", " `s"), (r" Iii\b", " 3"), (r" Ii\b", " 2"), (r" I\b", " 1"), (r" Iv\b", " 4"), (r" V\b", " 5")):
        c = F.regexp_replace(c, pattern, by)
    c = F.regexp_replace(c, "([0-9]+)", " $1 ")
    # a run of signs is one space, so there is one at either end at most
    return F.trim(F.regexp_replace(F.replace(c, F.lit("."), F.lit("")), "[^a-zA-Z0-9()']+", " "))


def correct_spelling(c: Column, dictionary: Mapping[str, Iterable[str]]) -> Column:
    """Each word's misspellings (regular expressions, whole words, any case) replaced by the word, in
    the dictionary's order, so corrections chain."""
    for word, wrong in dictionary.items():
        wrong = list(wrong)
        if wrong:
            c = F.regexp_replace(c, "(?i)" + "|".join(rf"\b{w}\b" for w in wrong), replacement(word))
    return F.regexp_replace(c, r"\A De \z", " de ")


def _python_title(text: str) -> str:
    return text.title()


def type_keywords(types: Iterable[str]) -> list[str]:
    """Full types and their words of more than 3 letters, longest first, then in order."""
    found = set()
    for t in types:
        title = _python_title(t)
        found.add(title)
        found.update(w for w in title.replace("/", " ").split(" ") if w.isalpha() and len(w) > 3)
    return sorted(found, key=lambda w: (-len(w), w))


def clean_type_info(c: Column, types: Iterable[str], abbreviations: Iterable[str]) -> Column:
    """Joins spaced abbreviations at either end (C S) and turns reversed two-word types around."""
    for a in sorted({a for a in abbreviations if len(a) <= 3}, key=lambda a: (-len(a), a)):
        spaced = " ".join(java_literal(x) for x in a)
        c = F.regexp_replace(c, f"(?i)^{spaced} ", replacement(f"{a} "))
        c = F.regexp_replace(c, f"(?i) {spaced}$", replacement(f" {a}"))
    for t in type_keywords(types):
        words = t.split()
        if len(words) == 2:
            c = F.regexp_replace(c, "(?i)" + " ".join(words[::-1]), replacement(t))
    return c


def remove_type_info(c: Column, types: Iterable[str], abbreviations: Iterable[str]) -> Column:
    """The name without type keywords (also inside words), abbreviations (whole words) and connectors."""
    c = title_case(c)
    keywords = type_keywords(types)
    if keywords:
        c = F.regexp_replace(c, "|".join(keywords), "")
    short = sorted({_python_title(a) for a in abbreviations}, key=lambda a: (-len(a), a))
    if short:
        c = F.regexp_replace(c, "|".join(rf"\b{a}\b" for a in short), " ")
    c = F.regexp_replace(c, r"\bDe\b|\bDo\b|\bDa\b|\bDu\b|^Dos|^Das", " ")
    return squeeze(c)


_CONNECTORS = "(?i)^de |^do |^da |^du | du$| de$| do$| da$|^de$|^do$|^da$|^du$"


def extract_type(clean: Column, final: Column) -> Column:
    """Words of ``clean`` that ``final`` lacks, once each and in order, title case; null if none."""
    a, b = F.upper(F.coalesce(clean, F.lit(""))), F.upper(F.coalesce(final, F.lit("")))
    words = lambda x: F.filter(F.split(x, r"\s+"), lambda w: w != "")
    rest = F.array_join(F.array_except(words(a), words(b)), " ")
    named = title_case(F.regexp_replace(squeeze(rest), _CONNECTORS, ""))
    return F.when(a == b, F.lit(None)).otherwise(F.nullif(named, F.lit("")))


#: Signs that a finished name shouldn't have, in the order they are looked for (fixed values).
SIGNS = ["?", "!", "//", "\\", "*", "!", "~", ")", "(", "&", "$", "+", "^", "%", "√¥", "√à", "`", "√ßo", "√®", "√©"]


def sanity_columns(name: Column, kind: Column, last_only: bool = False) -> dict[str, Column]:
    """name_length, type_length, special_chars and only_numeric. ``last_only`` keeps only the last sign."""
    name, kind = F.coalesce(name, F.lit("")), F.coalesce(kind, F.lit(""))
    signs = F.filter(F.array(*map(F.lit, SIGNS)), lambda s: F.contains(name, s))
    return {
        "name_length": F.length(name),
        "type_length": F.length(kind),
        "special_chars": F.coalesce(F.try_element_at(signs, F.lit(-1)), F.lit("")) if last_only else F.array_join(signs, ""),
        "only_numeric": F.when(name.rlike(r"^[0-9]+$"), "all_numerical").otherwise(""),
    }


#: Words of unaccented French and Portuguese types and how they are written, in the order in which
#: they are replaced (fixed values).
FRENCH = {
    "De": "de", "Sante": "Santé", "Hospitalier": "Hôpitalier", "Hopital": "Hôpital", "General": "Général", "Reference": "Référence",
    "Clinic": "Clinique", "Medical": "Médical", "Maternite": "Maternité", "Medico": "Médico", "Rehabilitation": "Réhabilitation",
    "Prive": "Privé", "La": "la", "Privée": "Privé", "Centre Hôpitalier": "Centre Hôpitalier", "Tradi-Praticien": "Tradipraticien",
    "Darrondissement": "d'Arrondissement", "Regional": "Régional", "Baptist Hôpital": "Baptist Hospital",
    "Catholic Hôpital": "Catholic Hospital", "Integre": "Integré", "Pediatrique": "Pédiatrique", "Prière": "Prière", "Medicament": "Médicament",
}
PORTUGUESE = {
    "De": "de", "Saude": "Saúde", "Missao": "Missão", "Missionario": "Missionário", "Referencia": "Referência", "Medico": "Médico",
    "Ortopedico": "Ortopédico", "Reabilitacao": "Reabilitação", "Medica": "Médica", "Clinica": "Clínica", "Catolica": "Católica",
    "Direccao": "Direcção", "Pediatrico": "pediátrico", "General": "Geral", "Darrondissement": "d'Arrondissement",
}


def fix_language(c: Column, language: str) -> Column:
    """Accents of a type's words put back; other languages than French and Portuguese change nothing."""
    for word, written in {"French": FRENCH, "Portuguese": PORTUGUESE}.get(language, {}).items():
        c = F.regexp_replace(c, rf"(?U)\b{_python_title(word)}\b", replacement(written))
    return c


def decimal_digits(lat: Column, long: Column) -> Column:
    """The fewer of the digits after the points of two coordinates."""
    count = lambda x: F.length(F.split_part(x.cast("string"), F.lit("."), F.lit(2)))
    return F.least(count(lat), count(long))


def with_standard_names(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``df`` with a precleaned column for each {source: output}."""
    return df.withColumns({out: preclean(F.col(source)) for source, out in columns.items()})

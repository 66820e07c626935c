"""Company-name normalisation and group roll-up keys.

Fixed values (they must equal the source pipeline's for equal results):

* LAB_NAME_PATTERN - the alternation removed from company names before
  they are compared; applied case-sensitively, globally, then upper-cased.
  Its quirks are part of the contract: alternation is first-match so ``SA``
  also fires inside words (``SANOFI`` -> ``NOFI``), and the unescaped ``.``
  in ``S.A.S`` / ``S.A`` matches any character.
* LEADING_ARTICLE_PATTERN - one leading article stripped, case-insensitive.
* DEFAULT_GROUP_RULES - ordered (prefixes, group) rules; first match wins;
  unmatched names fall back to their first word after the article strip.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, functions as F

from sunlight.functions._col import as_col

# --- fixed values ---------------------------------------------------------
LAB_NAME_PATTERN = "LABORATOIRES?|LABO|FRANCE|SAS|S.A.S|SA|S.A|DEVELOPPEMENT|SANTE|PHARMA"

LEADING_ARTICLE_PATTERN = "^(LES |LABORATOIRES? |LABO )"

DEFAULT_GROUP_RULES: list[tuple[tuple[str, ...], str]] = [
    (("SANOFI", "OPELLA"), "SANOFI/OPELLA"),
    (("PFIZER",), "PFIZER"),
    (("NOVARTIS",), "NOVARTIS"),
    (("BAYER",), "BAYER"),
    (("MERCK",), "MERCK"),
    (("SERVIER", "LES LABORATOIRES SERVIER"), "SERVIER"),
    (("BIOGARAN",), "BIOGARAN"),
    (("BOEHRINGER",), "BOEHRINGER INGELHEIM"),
    (("ASTRAZENECA",), "ASTRAZENECA"),
    (("VIATRIS",), "VIATRIS"),
]
# --------------------------------------------------------------------------


def normalise_lab_name(c, pattern: str = LAB_NAME_PATTERN) -> Column:
    """``UPPER(regexp_replace(name, pattern, ''))`` - comparison key for names."""
    return F.upper(F.regexp_replace(as_col(c), pattern, ""))


def strip_leading_article(c, pattern: str = LEADING_ARTICLE_PATTERN) -> Column:
    """Remove one leading article / company word, case-insensitively."""
    return F.regexp_replace(as_col(c), "(?i)" + pattern, "")


def group_key(c, rules: Sequence[tuple[Sequence[str], str]] = DEFAULT_GROUP_RULES) -> Column:
    """Group label: first rule whose prefix (case-sensitive) matches, else the
    first word of the name with its leading article removed."""
    name = as_col(c)
    fallback = F.split_part(strip_leading_article(name), F.lit(" "), F.lit(1))
    expr = None
    for prefixes, label in rules:
        cond = None
        for p in prefixes:
            term = name.startswith(p)
            cond = term if cond is None else (cond | term)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return fallback if expr is None else expr.otherwise(fallback)

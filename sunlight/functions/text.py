"""Text predicates, label clean-up and report formatting.

Fixed values:

* DEFAULT_SPECIALITY_RULES - ordered (ILIKE patterns, label) rewrites of the
  profession label; the branches are disjoint so one CASE equals the two
  in-place updates of the source pipeline.
* Report wording: ``" Milliards d'euros"`` above one billion, ``" M€"``
  otherwise, one decimal with a decimal comma; French digit grouping uses
  U+202F (narrow no-break space).
* Report sentences (HEADLINE, FUNDING, RETURN, SHARE, RESEARCH): their fixed
  parts, in order, with the values between them.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, functions as F

from sunlight.functions._col import as_col

# --- fixed values ---------------------------------------------------------
DEFAULT_SPECIALITY_RULES: list[tuple[tuple[str, ...], str]] = [
    (("Médecin%", "Docteur%"), "Médecin"),
    (("Pharmacien%",), "Pharmacien"),
]
BILLION_SUFFIX = " Milliards d'euros"
MILLION_SUFFIX = " M€"
FR_GROUP_SEPARATOR = "\u202f"
HEADLINE = ("AUDIT SUR ", " ANALYSÉS")
FUNDING = ("Cet acteur a perçu un financement cumulé de ", " € de la part du laboratoire ", ".")
RETURN = ("L'investissement est extrêmement rentable : pour chaque euro versé ici, la collectivité rembourse "
          "au laboratoire ", " € de médicaments de marque dans cette région.")
SHARE = ("Conséquence directe : dans ce secteur, ", "% des prescriptions du labo concernent ses produits de marque "
         "(ex: ", "), au détriment des génériques.")
RESEARCH = ("Note : Ce financement concerne la recherche. L'influence directe sur les ordonnances n'est pas encore "
            "indexée.")
# --------------------------------------------------------------------------


def escape_like(term: str, literal: bool = False) -> str:
    """Make ``term`` safe inside a LIKE pattern.

    The backslash (Spark's LIKE escape) is always doubled so a term such as
    ``a\\b`` matches itself; with ``literal`` the wildcards ``%`` and ``_``
    are escaped too, otherwise they keep their wildcard meaning.
    """
    out = term.replace("\\", "\\\\")
    if literal:
        out = out.replace("%", "\\%").replace("_", "\\_")
    return out


def ilike_any(c, patterns: Sequence[str]) -> Column:
    col = as_col(c)
    cond = None
    for p in patterns:
        term = col.ilike(p)
        cond = term if cond is None else (cond | term)
    return cond


def speciality_label(c, rules: Sequence[tuple[Sequence[str], str]] = DEFAULT_SPECIALITY_RULES) -> Column:
    """Collapse profession labels: first rule with a matching ILIKE wins."""
    col = as_col(c)
    expr = None
    for patterns, label in rules:
        cond = ilike_any(col, patterns)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return col if expr is None else expr.otherwise(col)


def _one_decimal_comma(x: Column) -> Column:
    return F.replace(F.format_string("%.1f", x), F.lit("."), F.lit(","))


def format_amount(c) -> Column:
    """``>= 1e9`` -> "x,y Milliards d'euros", else "x,y M€"."""
    x = as_col(c).cast("double")
    return (F.when(x >= 1e9, F.concat(_one_decimal_comma(x / 1e9), F.lit(BILLION_SUFFIX)))
            .otherwise(F.concat(_one_decimal_comma(x / 1e6), F.lit(MILLION_SUFFIX))))


def fr_grouped_integer(c) -> Column:
    """Round half-up to an integer and group digits the French way."""
    r = F.round(as_col(c).cast("decimal(38,6)"), 0)
    return F.replace(F.format_number(r, 0), F.lit(","), F.lit(FR_GROUP_SEPARATOR))


def sentence(parts: Sequence[str], *values: Column) -> Column:
    """Fixed parts with the values between them; a NULL value reads as empty."""
    out = [F.lit(parts[0])]
    for value, part in zip(values, parts[1:]):
        out += [F.coalesce(value.cast("string"), F.lit("")), F.lit(part)]
    return F.concat(*out)

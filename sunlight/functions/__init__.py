"""Column-expression builders. Everything here returns a ``Column`` that
stays inside whole-stage codegen; no Python UDFs."""

from sunlight.functions.money import (parse_comma_decimal, parse_fr_number,
                                      to_money_text)
from sunlight.functions.numeric import round_half_up, safe_div
from sunlight.functions.geo import department_code, postal_code, split_coordinate
from sunlight.functions.names import (LAB_NAME_PATTERN, DEFAULT_GROUP_RULES,
                                      normalise_lab_name, strip_leading_article,
                                      group_key)
from sunlight.functions.text import (escape_like, ilike_any, speciality_label,
                                     DEFAULT_SPECIALITY_RULES, format_amount,
                                     fr_grouped_integer, sentence)

__all__ = [
    "parse_comma_decimal", "parse_fr_number", "to_money_text", "round_half_up",
    "safe_div", "department_code", "postal_code", "split_coordinate",
    "LAB_NAME_PATTERN", "DEFAULT_GROUP_RULES", "normalise_lab_name",
    "strip_leading_article", "group_key", "escape_like", "ilike_any",
    "speciality_label", "DEFAULT_SPECIALITY_RULES", "format_amount",
    "fr_grouped_integer", "sentence",
]

"""Recipient search and landing figures (QRY-1..3, SCL-20/21).

The search matches a term against the recipient name anywhere, or against
the start of the city when the term is longer than three characters,
case-insensitively, ranks exact name > name prefix > other, then by
amount, and enriches the best rows with the company's ROI, brand share and
top products for the recipient's region. Results are sorted in that order.
"""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sunlight.functions import escape_like, format_amount, fr_grouped_integer, sentence
from sunlight.functions.text import FUNDING, HEADLINE, RESEARCH, RETURN, SHARE
from sunlight.operators import group_max_lookup, in_key_set, key_set, materialise, top_k
from sunlight.plans.columns import RAW, RX, DeclarationColumns, PrescriptionColumns
from sunlight.plans.declarations import recipient_regions, stg_declarations
from sunlight.plans.influence import influence_fact, influence_spend
from sunlight.plans.prescriptions import sales_mart
from sunlight.plans.recipients import recipient_totals, with_catalogue_names

# --- fixed values ----------------------------------------------------------
DEFAULT_PRODUCTS_LABEL = "leurs traitements brevetés"
GLOBAL_TOTAL_FALLBACK = 9_500_000_000.0   # used only when asked for
# ---------------------------------------------------------------------------

TIE_BREAK = ("nom", "prenom", "ville", "specialite", "labo_source", "labo_normalise",
             "region_code")


def _order(amount_col: str, extra: Sequence[str] = ()) -> list[Column]:
    return ([F.asc("priority"), F.desc_nulls_last(amount_col)]
            + [F.asc_nulls_last(c) for c in TIE_BREAK if c not in extra])


def _enrich(best: DataFrame, regions: DataFrame, influence: DataFrame,
            top_products: DataFrame) -> DataFrame:
    """Left-join region label -> (company, region) fact -> company products.

    The three right sides are keyed uniquely (dimension / aggregates), so
    the joins never multiply rows and can run after the top-k cut.
    """
    j = (best.alias("s")
         .join(regions.alias("r"), F.col("s.region_code") == F.col("r.code"), "left")
         .join(influence.alias("i"), (F.col("s.labo_normalise") == F.col("i.labo"))
               & (F.col("i.region") == F.col("r.libelle_reg")), "left")
         .join(top_products.alias("m"), F.col("s.labo_normalise") == F.col("m.labo_ansm"), "left"))
    return j.select("s.*",
                    F.coalesce(F.col("i.roi_influence"), F.lit(0.0)).alias("roi"),
                    F.coalesce(F.col("i.pct_princeps"), F.lit(0.0)).alias("part_de_marche"),
                    F.coalesce(F.col("m.top_produits"), F.lit(DEFAULT_PRODUCTS_LABEL)).alias("medocs"))


def _fill_numeric_zero(df: DataFrame) -> DataFrame:
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.fillna(0, subset=numeric) if numeric else df


def _matches(q: str, literal: bool, min_len: int) -> tuple[Column, Column]:
    """(row matches, priority) of a term over the columns nom and ville.

    ``q`` is bound as a literal value (never spliced into SQL text); a
    backslash matches itself, and ``%``/``_`` stay wildcards unless
    ``literal``. Terms shorter than ``min_len`` match no row.
    """
    pat = escape_like(q, literal)
    nom, ville = F.col("nom"), F.col("ville")
    hit = nom.ilike(f"%{pat}%")
    if len(q) > 3:
        hit = hit | ville.ilike(f"{pat}%")
    if len(q) < min_len:
        hit = F.lit(False)
    return hit, F.when(nom.ilike(pat), 1).when(nom.ilike(f"{pat}%"), 2).otherwise(3)


def search_recipients(recipients: DataFrame, regions: DataFrame, influence: DataFrame,
                      top_products: DataFrame, q: str, k: int = 15, literal: bool = False,
                      min_len: int = 2, amount_col: str = "montant_total") -> DataFrame:
    """QRY-1 over a recipient mart: one search term, best ``k`` rows, in order.

    The cut comes before the enrichment, and the k enriched rows are sorted
    again: joins promise no order.
    """
    hit, priority = _matches(q, literal, min_len)
    cand = recipients.where(hit).withColumn("priority", priority)
    best = top_k(cand, _order(amount_col), k)
    return _fill_numeric_zero(_enrich(best, regions, influence, top_products)).orderBy(*_order(amount_col))


def search_declarations(raw: DataFrame, name_map: DataFrame, dept_region: DataFrame, regions: DataFrame,
                        rx: DataFrame, bridge: DataFrame, top_products: DataFrame, q: str, k: int = 15,
                        literal: bool = False, min_len: int = 2, min_total: float = 500,
                        decl_cols: DeclarationColumns = RAW, rx_cols: PrescriptionColumns = RX,
                        fact: DataFrame | None = None) -> DataFrame:
    """QRY-1 straight from the declarations: the same rows as a search over the
    recipient mart, without building that mart.

    The filter reaches the payment rows; totals are cut to the best ``k`` before
    any lookup (a total is one result row at least, and the order begins with its
    own columns), catalogue names are added and the cut repeated. These k rows
    are written, and everything else is limited to them: the region lookup to
    their recipients, spend and sales to their companies. Give ``fact`` where
    that mart exists.
    """
    hit, priority = _matches(q, literal, min_len)
    wanted = raw.withColumns({"nom": F.col(decl_cols.name), "ville": F.col(decl_cols.city)}).where(hit).select(*raw.columns)
    totals = recipient_totals(wanted, min_total, cols=decl_cols).withColumn("priority", priority)
    early = [c for c in _order("montant_total", ("labo_normalise", "region_code"))]
    named = with_catalogue_names(top_k(totals, early, k), name_map)
    # Ties on the region cannot decide: rows that differ in nothing else share it.
    best = materialise(top_k(named, _order("montant_total", ("region_code",)), k), "search-best")

    stg = stg_declarations(raw, decl_cols)
    located = group_max_lookup(best, recipient_regions(stg, raw, dept_region, decl_cols, only=best),
                               ["nom", "ville"], "region_code", "region_code")
    if fact is None:
        companies = best.select(F.col("labo_normalise").alias("labo")).where("labo IS NOT NULL").distinct()
        spend = influence_spend(stg, name_map, raw, dept_region, cols=decl_cols, companies=companies)
        fact = influence_fact(spend, sales_mart(rx, bridge, rx_cols, companies=companies), regions)
    out = _fill_numeric_zero(_enrich(located, regions, fact, top_products))
    return out.orderBy(*_order("montant_total"))


GRAM, SHORT_GRAM, CITY_START = 3, 2, 4


def _grams(s: Column, n: int) -> Column:
    """All substrings of ``s`` of length ``n``."""
    return F.when(F.length(s) >= n, F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: s.substr(i, F.lit(n)))) \
        .otherwise(F.array().cast("array<string>"))


def _name_keys(s: Column) -> Column:
    """The grams by which a name is found: three letters, and two for two-letter terms."""
    return F.array_distinct(F.concat(_grams(s, GRAM), _grams(s, SHORT_GRAM)))


def _postings(values: DataFrame, grams: Column, wanted: Column) -> DataFrame:
    """(_key, value) for the wanted ones among the ``grams`` of ``values.value``."""
    return (values.withColumn("_wanted", wanted)
            .select("value", F.explode(F.filter(grams, lambda g: in_key_set(F.col("_wanted"), g))).alias("_key")))


def search_recipients_batch(recipients: DataFrame, regions: DataFrame, influence: DataFrame,
                            top_products: DataFrame, terms: DataFrame, term_col: str = "term",
                            k: int = 15, min_len: int = 2,
                            amount_col: str = "montant_total", salts: int = 8) -> DataFrame:
    """QRY-2: the search for a whole table of terms, best ``k`` rows per term.

    Terms are matched literally (no wildcards). Matching is an equi-join of grams over the
    different names and cities, not over recipients: a name offers those of its grams that some
    term asks for (a key set of fixed size tells, inside the array), a term is looked up by the one
    that the fewest names have, and the full term is then checked. The (term, name) and (term,
    city) pairs found are joined with the recipients, so that a recipient's row moves only for
    its hits. Where the planner must shuffle, a gram that many names have is dealt
    over ``salts`` partitions, and AQE splits a hot name. A (recipient, term) pair is produced once: city
    hits only when the name does not already match. The ranking is a per-term
    ``row_number`` whose partial limit runs before the shuffle, so a term
    matching a third of all recipients still moves only k rows per task.
    """
    t = (terms.select(F.col(term_col).alias("term")).where(F.length("term") >= max(1, min_len)).distinct()
         .select("term", F.lower("term").alias("_lterm")))
    cols = recipients.columns
    different = lambda c: recipients.select(F.lower(F.col(c)).alias("value")).where("value <> ''").distinct()
    length = F.length("_lterm")
    own = F.when(length == 1, F.array("_lterm")).when(length == SHORT_GRAM, F.array("_lterm")) \
        .otherwise(F.array_distinct(_grams(F.col("_lterm"), GRAM)))
    offered = t.select("term", "_lterm", F.explode(own).alias("_key"))
    # Terms of one letter have no gram: they are offered the letters themselves.
    letters = _grams(F.col("value"), 1) if min_len <= 1 else F.array().cast("array<string>")
    posted = _postings(different("nom"), F.array_distinct(F.concat(_name_keys(F.col("value")), letters)), key_set(offered, "_key"))
    common = posted.groupBy("_key").agg(F.count(F.lit(1)).alias("_names"))
    rarest = (offered.join(common, "_key").groupBy("term", "_lterm", F.size(own).alias("_asked"))
              .agg(F.min_by("_key", F.struct("_names", "_key")).alias("_key"), F.count(F.lit(1)).alias("_known")))
    # A term with a gram that no name has matches none.
    looked = rarest.where("_known = _asked").select("term", "_lterm", "_key") \
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = posted.withColumn("_salt", F.pmod(F.xxhash64("value"), F.lit(salts)).cast("int"))
    by_name = salted.join(looked, ["_key", "_salt"]).where(F.contains("value", F.col("_lterm"))).select("term", "_lterm", "value")
    starts = t.where(F.length("term") >= CITY_START).withColumn("_key", F.substring("_lterm", 1, CITY_START))
    cities = different("ville").withColumn("_key", F.substring("value", 1, CITY_START))
    by_city = cities.join(starts, "_key").where(F.startswith("value", F.col("_lterm"))).select("term", "_lterm", "value")

    lower_name = F.lower(F.coalesce(F.col("nom"), F.lit("")))
    hits = recipients.withColumn("value", F.lower("nom")).join(by_name, "value").select("term", *cols, "_lterm").unionByName(
        recipients.withColumn("value", F.lower("ville")).join(by_city, "value")
        .where(~F.contains(lower_name, F.col("_lterm"))).select("term", *cols, "_lterm"))
    priority = (F.when(lower_name == F.col("_lterm"), 1)
                .when(F.startswith(lower_name, F.col("_lterm")), 2).otherwise(3))
    ranked = (hits.withColumn("priority", priority).drop("_lterm")
              .withColumn("rank", F.row_number().over(
                  Window.partitionBy("term").orderBy(*_order(amount_col))))
              .where(F.col("rank") <= k)
              .withColumn("rank", F.col("rank").cast("bigint")))
    return _fill_numeric_zero(_enrich(ranked, regions, influence, top_products))


class LandingStats(NamedTuple):
    total: DataFrame
    top_groups: DataFrame


def landing_stats(recipients: DataFrame, k: int = 5, fallback: float | None = None,
                  amount_col: str = "montant_total", payer_col: str = "labo_source") -> LandingStats:
    """QRY-3: the global amount (``fallback`` when NULL or 0, if given) and
    the top ``k`` payers with their amount as 32-bit FLOAT."""
    total = F.sum(amount_col).cast("double")
    if fallback is not None:
        total = F.when(total.isNull() | (total == 0), F.lit(float(fallback))).otherwise(total)
    totals = recipients.agg(total.alias("total_global"))
    groups = (recipients.groupBy(F.col(payer_col).alias("groupe"))
              .agg(F.sum(amount_col).cast("float").alias("total")))
    return LandingStats(totals, top_k(groups, [F.desc_nulls_last("total"),
                                               F.asc_nulls_last("groupe")], k))


def landing_labels(totals: DataFrame) -> DataFrame:
    """SCL-20: the amount label of the global amount, and the headline around it."""
    label = format_amount("total_global")
    return totals.withColumn("label", label).withColumn("headline", sentence(HEADLINE, F.upper(label)))


def payer_labels(top_groups: DataFrame) -> DataFrame:
    """SCL-20: the amount label of each of the top payers."""
    return top_groups.withColumn("label", format_amount("total"))


def recipient_report(results: DataFrame, amount_col: str = "montant_total") -> DataFrame:
    """SCL-21: display fields and sentences of a search result row.

    A positive rounded ROI gives the sentences on return and share, any other
    the note on research.
    """
    spec = F.coalesce(F.nullif(F.col("specialite"), F.lit("")), F.lit("Institution"))
    roi = F.round(F.col("roi").cast("decimal(38,6)"), 0).cast("bigint")
    share = F.round(F.col("part_de_marche").cast("decimal(38,6)"), 0).cast("bigint")
    amount = fr_grouped_integer(amount_col)
    return results.select(
        "*",
        F.concat_ws(" ", "nom", "prenom").alias("title"),
        F.concat_ws(" — ", F.col("ville"), spec).alias("subtitle"),
        F.concat(amount, F.lit(" €")).alias("amount_label"),
        roi.alias("roi_rounded"), share.alias("share_rounded"),
        F.when(roi > 0, F.lit("influence")).otherwise(F.lit("research")).alias("message"),
        sentence(FUNDING, amount, F.col("labo_source")).alias("funding_text"),
        F.when(roi > 0, sentence(RETURN, roi)).otherwise(F.lit(RESEARCH)).alias("message_text"),
        F.when(roi > 0, sentence(SHARE, share, F.col("medocs"))).alias("share_text"))

"""Reference dimensions (SRC-7).

The defaults are literal rows (96 / 18 / 23), so they are returned marked for
broadcast: the size bound is the literal itself. (A frame built from local
rows is an RDD scan whose size the planner does not know, so without the
mark it would shuffle the large side to join a 96-row table.) Rows given
instead are marked only up to ``MARKED_ROWS``. ``path`` reads a dimension from a
CSV file with the same header, which a user can extend; ``write_dims`` writes
the defaults there to start from. The planner knows a file's size itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sunlight.sources.files import read_text_csv

# --- fixed values: department -> region (96 rows) --------------------------
DEPT_TO_REGION = [
    ("01", "84"), ("02", "32"), ("03", "84"), ("04", "93"), ("05", "93"), ("06", "93"),
    ("07", "84"), ("08", "44"), ("09", "76"), ("10", "44"), ("11", "76"), ("12", "76"),
    ("13", "93"), ("14", "28"), ("15", "84"), ("16", "75"), ("17", "75"), ("18", "24"),
    ("19", "75"), ("21", "27"), ("22", "53"), ("23", "75"), ("24", "75"), ("25", "27"),
    ("26", "84"), ("27", "28"), ("28", "24"), ("29", "53"), ("30", "76"), ("31", "76"),
    ("32", "76"), ("33", "75"), ("34", "76"), ("35", "53"), ("36", "24"), ("37", "24"),
    ("38", "84"), ("39", "27"), ("40", "75"), ("41", "24"), ("42", "84"), ("43", "84"),
    ("44", "52"), ("45", "24"), ("46", "76"), ("47", "75"), ("48", "76"), ("49", "52"),
    ("50", "28"), ("51", "44"), ("52", "44"), ("53", "52"), ("54", "44"), ("55", "44"),
    ("56", "53"), ("57", "44"), ("58", "27"), ("59", "32"), ("60", "32"), ("61", "28"),
    ("62", "32"), ("63", "84"), ("64", "75"), ("65", "76"), ("66", "76"), ("67", "44"),
    ("68", "44"), ("69", "84"), ("70", "27"), ("71", "27"), ("72", "52"), ("73", "84"),
    ("74", "84"), ("75", "11"), ("76", "28"), ("77", "11"), ("78", "11"), ("79", "75"),
    ("80", "32"), ("81", "76"), ("82", "76"), ("83", "93"), ("84", "93"), ("85", "52"),
    ("86", "75"), ("87", "75"), ("88", "44"), ("89", "27"), ("90", "27"), ("91", "11"),
    ("92", "11"), ("93", "11"), ("94", "11"), ("95", "11"), ("2A", "94"), ("2B", "94"),
]

# --- fixed values: region code -> label (18 rows) --------------------------
REGIONS = [
    ("01", "Guadeloupe"), ("02", "Martinique"), ("03", "Guyane"), ("04", "La Réunion"),
    ("06", "Mayotte"), ("11", "Île-de-France"), ("24", "Centre-Val de Loire"),
    ("27", "Bourgogne-Franche-Comté"), ("28", "Normandie"), ("32", "Hauts-de-France"),
    ("44", "Grand Est"), ("52", "Pays de la Loire"), ("53", "Bretagne"),
    ("75", "Nouvelle-Aquitaine"), ("76", "Occitanie"), ("84", "Auvergne-Rhône-Alpes"),
    ("93", "Provence-Alpes-Côte d Azur"), ("94", "Corse"),
]

# --- fixed values: speciality code -> label (23 rows) ----------------------
SPECIALITIES = [
    (1, "Médecine Générale"), (2, "Anesthésie-Réanimation"), (3, "Pathologie Cardio-Vasculaire"),
    (4, "Dermatologie"), (5, "Gastro-entérologie"), (6, "Radiodiagnostic et Imagerie"),
    (7, "Gynécologie Obstétrique"), (8, "Gastro-entérologie"), (9, "Médecine Interne"),
    (11, "Oto-Rhino-Laryngologie"), (12, "Pédiatrie"), (13, "Pneumologie"),
    (14, "Rhumatologie"), (15, "Ophthalmologie"), (17, "Psychiatrie"),
    (18, "Stomatologie"), (19, "Chirurgie Dentaire"), (31, "Médecine Physique et Réadaptation"),
    (32, "Neurologie"), (33, "Psychiatrie Infanto-Juvénile"), (35, "Néphrologie"),
    (37, "Anatomie-Cytopathologie"), (90, "Pharmacie"),
]
# ---------------------------------------------------------------------------

DEPT_SCHEMA = "dept_code string, region_code string"
REGION_SCHEMA = "code string, libelle_reg string"
SPECIALITY_SCHEMA = "code int, libelle string"


MARKED_ROWS = 10_000


def _dim(spark: SparkSession, rows, path: str | None, default, schema: str) -> DataFrame:
    if path is not None:
        columns = [field.split() for field in schema.split(", ")]
        return read_text_csv(spark, path).select(*[F.col(n).cast(t).alias(n) for n, t in columns])
    rows = list(default if rows is None else rows)
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= MARKED_ROWS else df


def dim_dept_region(spark: SparkSession, rows=None, path: str | None = None) -> DataFrame:
    return _dim(spark, rows, path, DEPT_TO_REGION, DEPT_SCHEMA)


def dim_region(spark: SparkSession, rows=None, path: str | None = None) -> DataFrame:
    return _dim(spark, rows, path, REGIONS, REGION_SCHEMA)


def dim_speciality(spark: SparkSession, rows=None, path: str | None = None) -> DataFrame:
    return _dim(spark, rows, path, SPECIALITIES, SPECIALITY_SCHEMA)


def write_dims(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """The default dimensions as CSV folders, to be extended by hand."""
    paths = {}
    for name, df in (("dept_region", dim_dept_region(spark)), ("region", dim_region(spark)),
                     ("speciality", dim_speciality(spark))):
        paths[name] = f"{out_dir}/{name}"
        df.write.mode("overwrite").option("header", True).csv(paths[name])
    return paths

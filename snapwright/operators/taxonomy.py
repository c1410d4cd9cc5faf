"""Eligibility names: rename to a canonical name, then bucket by dimension.

Both steps are joins to small two-column tables, so a user can swap the tables for their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Canonical name -> raw names it replaces.
RENAMES: dict[str, tuple[str, ...]] = {
    "Youth (below 21 years old)": ("Adolescents", "Youth"),
    "Chronic Illness": ("Alzheimers", "Cancer", "Seizure Disorder"),
    "Mental Illness": ("Dual Diagnosis",),
    "Families with children below 18 years old": ("I live with someone under 18 years of age",),
    "Substance Dependency": ("Smoker", "Alcoholic", "Opioid Addict", "People who use drugs"),
    "Transitional Aged Youth (TAY)": ("Young Adults (18-27 years old)", "Young Adults (20-30 years old)"),
    "Special Needs/Disabilities": (
        "Intellectual Disability", "Developmental Disability", "Disabled",
        "I am someone with disabilities", "Learning Disability", "Mentally Incapacitated",
    ),
    "API (Asian/Pacific Islander)": ("API", "Asian"),
    "African/Black": ("African American",),
    "Teens (13-18 years old)": ("Age 12-17",),
    "I am a Senior": ("Elderly",),
    "ESL/ELL (English Language Learner)": ("Limited English",),
    "Children (0-13 years old)": ("Young Children",),
}

# Dimension -> canonical names; every other name goes to OTHER.
OTHER = "other"
DIMENSIONS: dict[str, tuple[str, ...]] = {
    "age": (
        "Age 18-24", "All Ages", "I am a Senior", "Families with children below 18 years old",
        "Youth (below 21 years old)", "Infants", "Toddlers", "Children", "Children (0-13 years old)",
        "Pre-Teen", "Teens", "Teens (13-18 years old)", "Transitional Aged Youth (TAY)", "Adults",
        "Maturing Adult", "Senior",
    ),
    "education": (
        "ESL/ELL (English Language Learner)", "Continuing Education Students", "Preschool",
        "Elementary School", "Middle School Students", "High School Students", "Post-Grad", "College Students",
    ),
    "employment": (
        "Active Duty", "Employed", "National Guard", "Retired", "Sex Worker", "Veterans", "Unemployed",
    ),
    "ethnicity": (
        "African/Black", "API (Asian/Pacific Islander)", "Chinese", "Filipino/a", "Jewish", "Latinx",
        "Middle Eastern and North African", "Native American", "Pacific Islander", "Samoan",
    ),
    "family_status": (
        "Adoption", "CIP (Children of Incarcerated Parents)", "Foster Youth", "Individuals",
        "Single Parent", "Married no children",
    ),
    "financial": ("Benefit Recipients", "Low-Income", "Underinsured", "Uninsured"),
    "gender": ("LGBTQ+", "Men", "Non-Binary", "Transgender and Gender Non-Conforming", "Women"),
    "health": (
        "Abuse or Neglect Survivors", "Chronic Illness", "Deaf or Hard of Hearing", "HIV/AIDS",
        "Limited Mobility", "Mental Illness", "Pregnant", "PTSD", "Special Needs/Disabilities",
        "Substance Dependency", "Terminal Illness", "Visual Impairment",
    ),
    "immigration": ("Immigrants", "Refugees", "Undocumented"),
    "housing": (
        "Home Owners", "Home Renters", "Homeless", "Homeless Youth", "Experiencing Homelessness",
        "Imminent Risk of Eviction", "In Jail", "Near Homeless", "Re-Entry",
    ),
    "other": (
        "Anyone in Need", "Disaster Victim", "Domestic Violence Survivors", "Gender-Based Violence",
        "Human Trafficking Survivors", "San Francisco Residents", "Sexual Assault Survivors",
        "Trauma Survivors",
    ),
}


def pair_table(spark: SparkSession, groups: dict[str, tuple[str, ...]], member: str, group: str) -> DataFrame:
    """(member, group) rows as an inline table, so that the optimizer knows its size."""
    return spark.sql(f"select * from values {pair_values(groups)} as t({member}, {group})")


def pair_values(groups: dict[str, tuple[str, ...]]) -> str:
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    return ", ".join(f"({quote(m)}, {quote(g)})" for g, members in groups.items() for m in members)


@dataclass(frozen=True)
class Taxonomy:
    """``renames``: (raw, canonical); ``buckets``: (canonical, dimension). One row per first column."""

    renames: DataFrame
    buckets: DataFrame

    @classmethod
    def default(cls, spark: SparkSession) -> "Taxonomy":
        return cls(
            renames=pair_table(spark, RENAMES, "raw", "canonical"),
            buckets=pair_table(spark, DIMENSIONS, "canonical", "dimension"),
        )


def rename_by(df: DataFrame, name: str, renames: DataFrame, out: str) -> DataFrame:
    """Exact, case-sensitive renaming; names outside the table and NULL pass through."""
    pairs = renames.select(F.col("raw").alias("__raw"), F.col("canonical").alias("__canonical"))
    joined = df.join(pairs, F.col(name) == F.col("__raw"), "left")
    return joined.withColumn(out, F.coalesce("__canonical", name)).drop("__raw", "__canonical")


def bucket_by(df: DataFrame, name: str, buckets: DataFrame, out: str, default: str = OTHER) -> DataFrame:
    """Dimension of a name; names outside the table and NULL go to ``default``."""
    pairs = buckets.select(F.col("canonical").alias("__name"), F.col("dimension").alias("__bucket"))
    joined = df.join(pairs, F.col(name) == F.col("__name"), "left")
    return joined.withColumn(out, F.coalesce("__bucket", F.lit(default))).drop("__name", "__bucket")


def classify(eligibilities: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """(id, resolved_name, dimension) for each eligibility."""
    renamed = rename_by(eligibilities.select("id", "name"), "name", taxonomy.renames, "resolved_name")
    return bucket_by(renamed, "resolved_name", taxonomy.buckets, "dimension").select(
        "id", "resolved_name", "dimension"
    )

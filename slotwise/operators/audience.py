"""Recipients × campaigns — C6, C7, D-5, D-6, H10, H11.

The audience is the one large table of the job. It is built with one shuffle
join (segment map ⋈ profiles on the recipient key); the campaign side is a
size-checked broadcast, and a single ``distinct`` after the join removes the
duplicates both inputs can carry: ``distinct(A ⋈ B) = distinct(distinct(A) ⋈ B)``,
and the aggregate reuses the join's hash partitioning, so it adds no exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.keys import normalize_locale, segment_ids
from slotwise.operators.skew import heavy_keys, salted_join, salts_for
from slotwise.operators.util import broadcast_checked

# Fixed values (must equal the reference's): join and cohort keys.
CAMPAIGN_KEYS = ["campaign_segment_type_id", "tpid", "eapid", "locale"]
RECIPIENT_KEYS = ["email_address", "test_keys", "tpid", "eapid", "locale"]
COHORT_KEYS = ["campaign_id", "test_keys", "segment_type_id"]


def read_profiles(profiles: DataFrame) -> DataFrame:
    """A3: active recipients (``mer_status = 1``, pushed to the scan), locale lower-cased."""
    return normalize_locale(profiles.filter(F.col("mer_status") == 1))


def launch_campaigns(meta: DataFrame) -> DataFrame:
    """Distinct (segment, campaign, priority, scope) rows of the launch."""
    return meta.select("campaign_segment_type_id", "campaign_id", "priority", "tpid", "eapid", "locale").distinct()


def assign_campaigns(
    segments: DataFrame, meta: DataFrame, max_broadcast_rows: int = 2_000_000, known: tuple[int, int] | None = None
) -> DataFrame:
    """Recipients receive every campaign targeting one of their segments.

    ``segment_type_id`` becomes the recipient's ``#``-joined segment list.
    ``known`` is a measured upper bound (rows, bytes) of the metadata.
    """
    campaigns = broadcast_checked(launch_campaigns(meta), max_broadcast_rows, known, closer=True)
    seg = (
        normalize_locale(segments)
        .withColumnRenamed("segment_type_id", "campaign_segment_type_id")
        .withColumnRenamed("segment_type_id_concat", "segment_type_id")
    )
    return seg.join(campaigns, CAMPAIGN_KEYS)


def build_audience(assigned: DataFrame, profiles: DataFrame, columns: list[str] | None = None, heavy_share: float | None = None) -> DataFrame:
    """C7 + D-5: assigned campaigns ⋈ active profiles, distinct.

    ``columns``: the profile columns later stages read; only they (and the
    keys) are shuffled, hashed and cached, however wide the profile table is.
    Profile rows that differ in other columns only become one row.
    ``heavy_share``: recipients with such a share of the assigned rows are
    found by a sketch first and spread over the partitions (equal rows stay
    together, so the distinct still needs no exchange of its own kind).
    """
    if columns is not None:
        profiles = profiles.select(*dict.fromkeys([*RECIPIENT_KEYS, *columns]))
    heavy = heavy_keys(assigned, RECIPIENT_KEYS, heavy_share) if heavy_share else []
    return salted_join(assigned, profiles, RECIPIENT_KEYS, "inner", heavy, salts_for(assigned)).distinct()


def cohorts(audience: DataFrame) -> DataFrame:
    """D-6: distinct (campaign, bucket, segment list) — the unit of module allocation."""
    return audience.select(*COHORT_KEYS).distinct()


def segment_members(df: DataFrame, col: str = "segment_type_id") -> DataFrame:
    """One row per segment id of a ``#`` list."""
    return df.select("*", F.explode(F.array_distinct(segment_ids(col))).alias("segment_id"))


def content_key_columns(attribute_columns: list[str]) -> list[str]:
    """The columns that decide a row's content: cohort, campaign priority and
    every recipient attribute a binding or template names."""
    return COHORT_KEYS + ["priority"] + sorted(set(attribute_columns) - set(COHORT_KEYS) - {"priority"})


def content_keys(audience: DataFrame, attribute_columns: list[str]) -> DataFrame:
    """D-5/H11: distinct content keys. Recipients that share a key get the same
    content, so rendering runs once per key (partial aggregation before the
    shuffle keeps this cheap when keys repeat)."""
    return audience.select(*content_key_columns(attribute_columns)).distinct()

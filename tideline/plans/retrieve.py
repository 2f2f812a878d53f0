"""Retrieve: the warehouse tables joined to one wide row per contact (or per deal and course)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.dates import anchor_date, epoch_seconds
from tideline.functions.numeric import KRONE_IN_EURO, krone_to_euro
from tideline.functions.text import map_values, merge_value
from tideline.operators import aggregates, columns, joins, snapshots
from tideline.plans import values
from tideline.session import materialize
from tideline.sources.tables import read_table


def open_tables(spark: SparkSession, stage: str = "dev", database: str = "refined") -> dict[str, DataFrame]:
    """The source tables from the catalog."""
    return {
        name: read_table(spark, database, table, stage=stage, from_prod=True)
        for name, table in values.SOURCE_TABLES.items()
    }


def courses(raw: DataFrame, verticals: DataFrame) -> DataFrame:
    """Current, non-legacy courses with readable type, country, vertical and euro fee."""
    offered = raw.where(
        (F.col("erogation_entity").isNull() | (F.col("erogation_entity") == "tag")) & (F.col("type") != "async")
    )
    current = snapshots.latest_snapshot(offered).where(~F.coalesce("legacy_product", F.lit(False)))
    named = joins.lookup(current, verticals, "vertical", "tag_vertical_id", "tag_vertical_name", "vertical_name")
    return named.withColumns(
        {
            "country": map_values(F.col("subsidiary"), values.SUBSIDIARY_COUNTRY),
            "type": columns.recode(F.col("type"), values.COURSE_TYPES),
            "tuition_fee_amount": krone_to_euro(F.col("tuition_fee_amount"), F.col("course_currency_code")),
        }
    )


def deals(
    raw: DataFrame, stages: DataFrame, linked: DataFrame, deleted: DataFrame, merged: DataFrame, krone: DataFrame
) -> DataFrame:
    """Consumer deals with a course, readable stage and euro amount."""
    private = raw.where((F.col("sales_channel") != "B2B") & (F.col("sales_channel") != "B2G"))
    kept = joins.keep_keys(private, linked.select("deal_id").distinct(), "id", ["deal_id"])
    kept = joins.drop_keys(kept, "id", deleted, merged)
    staged = joins.lookup(kept, stages, "dealstage", "stage_id", "stage_name", "dealstage")
    typed = staged.withColumns(
        {
            "motivation": F.col("motivation").try_cast("double"),
            "dealstage": merge_value(F.col("dealstage"), "Closed Won (SO NetSuite)", "Closed Won"),
        }
    )
    return joins.scale_listed(typed, "id", "amount", krone, KRONE_IN_EURO)


def meetings(raw: DataFrame) -> DataFrame:
    outcome = merge_value(F.col("hs_meeting_outcome"), "RESCHEDULED", "SCHEDULED")
    return raw.withColumns(
        {
            "meeting_id": F.col("id"),
            "merge_date": F.to_date("hs_meeting_start_time"),
            "meetings_create_date": F.to_date("createdat"),
            "hs_meeting_outcome": outcome,
            "hs_meeting_outcome_ranked": map_values(outcome, values.MEETING_OUTCOME_RANKS),
        }
    )


def meeting_pivot(prepared: DataFrame, kind: str) -> DataFrame:
    """Distinct meetings per deal: by outcome for one kind, or by kind for ``All``."""
    if kind == "All":
        return aggregates.pivot_unique(
            prepared, "deal_id", "hs_activity_type", "meeting_id", values.MEETINGS_BOOKED
        )
    stem = kind.lower()
    names = {
        o: f"{stem}_{o.replace('COMPLETED', 'DONE').replace(' ', '_').lower()}" for o in values.MEETING_OUTCOMES
    }
    rows = prepared.where(F.col("hs_activity_type") == kind)
    expected = [f"{stem}_{s}" for s in values.MEETING_SUFFIXES_EXPECTED]
    return aggregates.pivot_unique(rows, "deal_id", "hs_meeting_outcome", "meeting_id", names, expected)


def calls(raw: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Calls with an owner, their readable outcome and whether they were answered."""
    owned = columns.integers_only(raw, "hubspot_owner_id").withColumnRenamed("id", "call_id")
    named = joins.lookup(
        owned, outcomes, "hs_call_disposition", "id", "label", "hs_call_disposition", "Call Outcome Not Specified"
    )
    return named.withColumns(
        {
            "hs_activity_type": F.coalesce("hs_activity_type", F.lit("Call Type Not Specified")),
            "answered_bool": columns.member_flag(F.col("hs_call_disposition"), values.ANSWERED_OUTCOMES),
            "merge_date": F.to_date("createdat"),
        }
    )


def call_summary(prepared: DataFrame, links: DataFrame, deals: DataFrame | None = None) -> DataFrame:
    """Per deal: distinct calls overall, by outcome and direction, and durations; only of ``deals``, if given."""
    latest = snapshots.latest_with_ties(links, "call_id", "dumpdate").select("call_id", "deal_id")
    if deals is not None:
        latest = joins.keep_keys(latest, deals, "deal_id", ["deal_id"])
    linked = prepared.join(latest, "call_id")
    return aggregates.conditional_unique(
        linked,
        "deal_id",
        "call_id",
        {
            "n_calls": F.lit(True),
            "n_calls_positive_outcome": F.col("answered_bool") == 1,
            "n_calls_negative_outcome": F.col("answered_bool") == 0,
            "n_inbound_calls": F.col("hs_call_direction") == "INBOUND",
            "n_outbound_calls": F.col("hs_call_direction") == "OUTBOUND",
        },
        {"avg_call_duration": ("avg", "hs_call_duration"), "total_call_duration": ("sum", "hs_call_duration")},
    )


def contact_links(raw: DataFrame, contacts: DataFrame, deleted: DataFrame, deal_ids: DataFrame) -> DataFrame:
    """The newest contact of each deal, without merged, deleted and deal-less contacts."""
    merged = joins.split_ids(contacts, "hs_calculated_merged_vids")
    idle = contacts.where(F.col("num_associated_deals") == 0).select("id")
    live = joins.drop_keys(raw, "contact_id", idle, deleted, merged)
    newest = snapshots.latest_per_key(
        live.select("deal_id", "contact_id", "dumpdate"), ["deal_id"], "dumpdate", ["contact_id"]
    )
    return joins.keep_keys(newest, deal_ids, "deal_id", ["id"])


def retrieve(tables: Mapping[str, DataFrame], per: str = "key", country: str = "Italy") -> DataFrame:
    """The wide feature table.

    ``per='key'`` keeps one row per contact, ``per='row'`` one per deal and course.
    """
    t = tables
    # Rows travel as numbers of their deal and course, which may repeat their ids; the columns join in at the end.
    course = courses(t["courses"], t["verticals"]).select("id", "country", "course_currency_code", *values.COURSE_COLUMNS)
    course = materialize(course.withColumn("__course", F.monotonically_increasing_id()), "courses")
    of_contact = ["source_of_awareness", "hs_calculated_merged_vids", "num_associated_deals", *values.ENRICHED_CONTACT, *values.DECLARED_CONTACT]
    contacts = columns.select_present(snapshots.any_per_key(t["contacts"], ["id"]), ["id", *of_contact])
    contacts = materialize(contacts, "contacts")
    # Written lookups have a known size: a small one does not make Spark shuffle the table that it joins.
    stages = materialize(t["deal_stages"].select("stage_id", "stage_name", "pipeline_label"), "deal-stages")
    outcomes = materialize(t["call_outcomes"].select("id", "label"), "call-outcomes")
    deleted_deals = t["deal_events"].where(F.col("ingestion_event_type") == "deal.deletion").select("id")
    deleted_contacts = t["contact_events"].where(F.col("ingestion_event_type") == "contact.deletion").select("id")
    merged_deals = joins.split_ids(t["deals"], "hs_merged_object_ids", part=None)

    links = t["course_to_deal"].where(F.col("course_id") != 0).select("deal_id", "course_id")
    links = joins.drop_keys(joins.keep_keys(links, course, "course_id", ["id"]), "deal_id", deleted_deals, merged_deals)
    links = materialize(links, "links")  # read three times below
    krone = joins.keep_keys(
        links, course.where(F.col("course_currency_code") == "DKK"), "course_id", ["id"]
    ).select("deal_id")
    deal = deals(t["deals"], stages, links, deleted_deals, merged_deals, krone).select(
        "id",
        F.col("hs_object_id").alias("deal_id"),
        F.col("source_of_awareness").alias("source_of_awareness_playbook"),
        *values.DEAL_COLUMNS,
        F.monotonically_increasing_id().alias("__deal"),
    )
    deal = materialize(deal, "deals")
    # Rows without a contact have no snapshot either.
    contact_of = contact_links(t["contact_to_deal"], contacts, deleted_contacts, deal.select("id")).select(
        F.col("deal_id").alias("id"), "contact_id"
    ).where(F.col("contact_id").isNotNull())

    times = columns.merge_stage_columns(t["deal_stage_times"], stages).select(
        "id", "closed_won_entered", "closed_lost_entered"
    )
    # One row per contact is chosen among the courses of all countries.
    offered = course.where(F.col("country") == country) if per == "row" else course
    anchored = (
        deal.select("id", "deal_id", "dealstage", "__deal")
        .join(contact_of, "id")
        .join(times, "id", "left")
        .join(links.withColumnRenamed("deal_id", "id"), "id")
        .join(offered.select(F.col("id").alias("course_id"), "start_date", "__course"), "course_id")
        .withColumn(
            "compare_date",
            anchor_date(F.col("dealstage"), F.col("closed_won_entered"), F.col("closed_lost_entered"), F.col("start_date")),
        )
        .withColumn("compare_date_epoch", epoch_seconds(F.col("compare_date")))
    )
    ties = [] if per == "row" else ["id", "course_id"]
    # The search below reads its rows several times: compute the joins once.
    anchored = materialize(
        anchored.select("contact_id", "compare_date", "compare_date_epoch", "deal_id", "__deal", "__course", *ties), "anchored"
    )
    stamps = t["contact_history"].select(F.col("id").alias("contact_id"), "dumpdate")
    placed = snapshots.nearest_snapshot(anchored, stamps, "contact_id", "compare_date_epoch", "dumpdate", per, ties)

    placed = materialize(placed.drop(*ties), "placed")
    known = set(t["contact_history"].columns)
    history = t["contact_history"].select(
        F.col("id").alias("contact_id"), "dumpdate", *[c for c in values.CONTACT_ANALYTICS if c in known]
    )
    # Of the largest table only the snapshots that were placed are read on.
    pairs = placed.select("contact_id", "dumpdate").distinct()
    asked = joins.keep_keys(history, pairs, ["contact_id", "dumpdate"], ["contact_id", "dumpdate"])
    analytics = snapshots.any_per_key(asked, ["contact_id", "dumpdate"])
    people = contacts.select(
        F.col("id").alias("contact_id"),
        F.col("source_of_awareness").alias("source_of_awareness_onboarding"),
        *[c for c in values.ENRICHED_CONTACT + values.DECLARED_CONTACT if c in set(contacts.columns)],
    )
    known_of = pairs.join(analytics, ["contact_id", "dumpdate"], "left").join(people, "contact_id", "left")

    held = joins.keep_keys(meetings(t["meetings"]), placed, "deal_id", ["deal_id"])
    interviews = meeting_pivot(held, "Interview")
    called = call_summary(calls(t["calls"], outcomes), t["call_to_deal"], placed).drop("avg_call_duration")
    # Meetings and calls join one row per deal, not one per course of it.
    dealt = deal.drop("id").join(interviews, "deal_id", "left").join(called, "deal_id", "left")

    base = (
        placed.drop("deal_id")
        .join(known_of, ["contact_id", "dumpdate"])
        .join(dealt, "__deal")
        .join(course.where(F.col("country") == country).withColumnRenamed("id", "course_id"), "__course")
    )
    keep = [
        "deal_id", "contact_id", *values.ENRICHED_CONTACT, "compare_date", "compare_date_epoch", *values.CONTACT_ANALYTICS,
        "course_id", *values.COURSE_COLUMNS, *values.DEAL_COLUMNS, "source_of_awareness_playbook",
        *values.DECLARED_CONTACT, "source_of_awareness_onboarding",
        *[c for c in interviews.columns + called.columns if c != "deal_id"],
    ]
    return columns.select_present(base, keep)


def labelled(base: DataFrame, training: bool = True) -> DataFrame:
    """Add the target: won or not when training, -1 when scoring."""
    if not training:
        return base.withColumn("target", F.lit(-1))
    return columns.drop_sparse(columns.label_from_stage(base, "dealstage", values.WON_STAGES))

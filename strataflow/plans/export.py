"""Nested JSON records of wellbores, logs and trajectories for an industry data platform."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACL = {"owners": ["data.default.owners@partition"], "viewers": ["data.default.viewers@partition"]}
LEGAL = {"legaltags": ["partition-public-data"], "otherRelevantDataCountries": ["NO"], "status": "compliant"}
#: Spellings of the metre in source units. Fixed values.
METRES = ("M", "METRE", "METER")


def escaped(c: Column | str) -> Column:
    """Identifier part: per cent, slash and space escaped."""
    out = F.col(c) if isinstance(c, str) else c
    for plain, code in (("%", "%25"), ("/", "%2F"), (" ", "%20")):
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def record_id(partition: str, entity: str, c: Column | str) -> Column:
    return F.concat(F.lit(f"{partition}:{entity}:"), escaped(c))


def filled(array: Column) -> Column:
    """The array, null if it is empty, so that JSON leaves it out."""
    return F.when(F.size(array) > 0, array)


def _envelope(kind: str) -> list[Column]:
    lists = lambda d: F.struct(*[(F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)).alias(k) for k, v in d.items()])
    return [F.lit(f"osdu:wks:{kind}").alias("kind"), lists(ACL).alias("acl"), lists(LEGAL).alias("legal")]


def _midnight(c: str) -> Column:
    return F.concat(F.date_format(c, "yyyy-MM-dd"), F.lit("T00:00:00Z"))


def wellbore_records(versions: DataFrame, identities: DataFrame, partition: str = "partition") -> DataFrame:
    """One record per wellbore version: (wellbore_uid, version_number, record)."""
    aliases = identities.where("wellbore_uid is not null").groupBy("wellbore_uid").agg(
        F.array_sort(F.collect_set(F.struct(F.col("source_identifier").alias("AliasName"), F.col("source_system").alias("DefinitionOrganisationID")))).alias("_aliases"),
        F.count_distinct("source_system").alias("_systems"),
        F.max("sidetrack").alias("_sidetrack"),
    )
    rows = versions.join(aliases, "wellbore_uid", "left")
    state = F.struct(F.col("well_role").alias("FacilityStateTypeID"), _midnight("valid_from").alias("EffectiveDateTime"), _midnight("valid_to").alias("TerminationDateTime"))
    data = F.struct(
        F.col("wellbore_uid").alias("FacilityName"),
        F.when(F.col("well_role") != "UNKNOWN", F.array(state)).alias("FacilityStates"),
        F.when(F.col("operator_label").isNotNull(), F.array(F.struct(F.col("operator_label").alias("FacilityOperatorOrganisationID")))).alias("FacilityOperators"),
        filled(F.col("_aliases")).alias("NameAliases"),
        F.struct(
            F.col("_sidetrack").alias("SidetrackCode"), F.size("_aliases").alias("IdentityVariantCount"), F.col("_systems").alias("SourceSystemCount"), F.col("well_role").alias("WellRole")
        ).alias("ExtensionProperties"),
    )
    body = F.struct(record_id(partition, "master-data--Wellbore", "wellbore_uid").alias("id"), F.col("version_number").alias("version"), *_envelope("master-data--Wellbore:1.0.0"), data.alias("data"))
    return rows.select("wellbore_uid", "version_number", F.to_json(body, {"ignoreNullFields": "true"}).alias("record"))


def welllog_records(samples: DataFrame, partition: str = "partition", refuse_unresolved: bool = False) -> DataFrame:
    """One record per source file with its curves, depth range and counts: (source_file, record)."""
    if refuse_unresolved:
        samples = samples.withColumn("wellbore_uid", F.coalesce("wellbore_uid", F.raise_error(F.concat(F.lit("unresolved wellbore in "), "_source_file")).cast("string")))
    samples = samples.where("wellbore_uid is not null")
    unit = F.when(F.upper(F.trim(F.max("index_unit"))).isin(*METRES), "m").otherwise(F.max("index_unit"))
    curves = samples.groupBy("_source_file", "mnemonic").agg(
        F.max("wellbore_uid").alias("_uid"), F.min("index_value").alias("TopDepth"), F.max("index_value").alias("BaseDepth"), unit.alias("DepthUnit"),
        F.count_if("was_sentinel").alias("SentinelReadingCount"), F.count("*").alias("SampleCount"),
    )
    fields = ("TopDepth", "BaseDepth", "DepthUnit", "SentinelReadingCount", "SampleCount")
    curve = F.struct(F.col("mnemonic").alias("Mnemonic"), *fields)
    files = curves.groupBy("_source_file").agg(
        F.max("_uid").alias("_uid"), F.array_sort(F.collect_list(curve)).alias("_curves"), F.min("TopDepth").alias("_top"), F.max("BaseDepth").alias("_base"),
        F.sum("SampleCount").alias("_samples"), F.sum("SentinelReadingCount").alias("_sentinels"),
    )
    data = F.struct(
        F.element_at(F.split("_source_file", "/"), -1).alias("Name"), record_id(partition, "master-data--Wellbore", "_uid").alias("WellboreID"), F.col("_top").alias("TopMeasuredDepth"),
        F.col("_base").alias("BottomMeasuredDepth"), filled(F.col("_curves")).alias("Curves"), F.struct(F.col("_samples").alias("SampleCount"), F.col("_sentinels").alias("SentinelReadingCount")).alias("ExtensionProperties"),
    )
    body = F.struct(record_id(partition, "work-product-component--WellLog", "_source_file").alias("id"), *_envelope("work-product-component--WellLog:1.0.0"), data.alias("data"))
    return files.select(F.col("_source_file").alias("source_file"), F.to_json(body, {"ignoreNullFields": "true"}).alias("record"))


def trajectory_records(stations: DataFrame, partition: str = "partition") -> DataFrame:
    """One record per survey with its depth range and the properties it has: (trajectory_uid, record)."""
    known = stations.where("trajectory_uid is not null and wellbore_uid is not null")
    present = {"MD": "md", "TVD": "tvd", "Inclination": "inclination_deg", "Azimuth": "azimuth_deg", "DogLegSeverity": "reported_dls"}
    rows = known.groupBy("trajectory_uid").agg(
        F.max("wellbore_uid").alias("_uid"), F.min("md").alias("_top"), F.max("md").alias("_base"), F.count("*").alias("_stations"),
        F.array_compact(F.array(*[F.when(F.count(c) > 0, n) for n, c in present.items()])).alias("_present"),
    )
    data = F.struct(
        record_id(partition, "master-data--Wellbore", "_uid").alias("WellboreID"), F.col("_top").alias("TopDepthMeasuredDepth"), F.col("_base").alias("BaseDepthMeasuredDepth"),
        filled(F.transform("_present", lambda p: F.struct(p.alias("Name")))).alias("AvailableTrajectoryStationProperties"), F.struct(F.col("_stations").alias("StationCount")).alias("ExtensionProperties"),
    )
    body = F.struct(record_id(partition, "work-product-component--WellboreTrajectory", "trajectory_uid").alias("id"), *_envelope("work-product-component--WellboreTrajectory:1.1.0"), data.alias("data"))
    return rows.select("trajectory_uid", F.to_json(body, {"ignoreNullFields": "true"}).alias("record"))


def invalid_records(records: DataFrame) -> DataFrame:
    """Rows of ``record`` that lack what every record needs, with all the reasons."""
    field = lambda path: F.get_json_object("record", path)
    reasons = F.array_compact(
        F.array(
            F.when(field("$.id").isNull(), "id is missing"),
            F.when(~F.coalesce(field("$.id").rlike(r"^[\w\-\.]+:[\w\-\.]+:[^\s/]+$"), F.lit(False)), "id is malformed"),
            F.when(~F.coalesce(field("$.kind").rlike(r"^[\w\-\.]+:[\w\-\.]+:[\w\-\.]+:[0-9]+\.[0-9]+\.[0-9]+$"), F.lit(False)), "kind is malformed"),
            F.when(field("$.acl.owners[0]").isNull() | field("$.acl.viewers[0]").isNull(), "acl is incomplete"),
            F.when(field("$.legal.legaltags[0]").isNull(), "legal is incomplete"),
            F.when(field("$.data").isNull(), "data is missing"),
        )
    )
    return records.withColumn("reasons", reasons).where(F.size("reasons") > 0)


#: Parts that each kind of record must have besides the envelope: path, and the JSON types it may be. Fixed values of our own.
DECLARED = {
    "master-data--Wellbore": (("$.data.FacilityName", "string"), ("$.version", "number"), ("$.data.ExtensionProperties.WellRole", "string")),
    "work-product-component--WellLog": (("$.data.Name", "string"), ("$.data.WellboreID", "string"), ("$.data.TopMeasuredDepth", "number"), ("$.data.BottomMeasuredDepth", "number")),
    "work-product-component--WellboreTrajectory": (("$.data.WellboreID", "string"), ("$.data.ExtensionProperties.StationCount", "number")),
}


def schema_failures(records: DataFrame, declared: dict[str, tuple] = DECLARED) -> DataFrame:
    """One row per declared part that a record lacks or has of another type: ``records``' columns and ``failure``.

    A record is held against the entity that its kind names; a kind that isn't declared fails as such.
    """
    parts = F.split(F.get_json_object("record", "$.kind"), ":")
    entity = F.try_element_at(parts, F.lit(3))
    failures = [F.when(entity.isNull() | ~entity.isin(*declared), F.concat(F.lit("kind is not declared: "), F.coalesce(entity, F.lit("none"))))]
    for name, fields in declared.items():
        for path, kind in fields:
            value = F.get_json_object("record", path)
            fault = F.when(value.isNull(), f"{path} is missing")
            if kind == "number":
                fault = fault.when(value.try_cast("double").isNull(), f"{path} is not a number")
            failures.append(F.when(entity == name, fault))
    return records.withColumn("failure", F.explode(F.array_compact(F.array(*failures))))


def first_records(records: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n records in the given order, the same ones whenever it is asked for."""
    return records.orderBy(*order).limit(n)

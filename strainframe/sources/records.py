"""From frozen canonical records to a dataset: records, samples, calls and evidence tables.

A record is a map from field names to variants, as records carry any fields
with a known prefix.  What cannot be used gives a row with its problem.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import scalars as S
from ..functions import vocabulary as V

# The columns of every sample, in order.
SAMPLE_COLUMNS = ["sample_id", "label", "role", "species", "mlst_scheme", "mlst_st", "collection_date", "date_start", "date_end", "date_precision", "country", "region", "nuts2", "host", "isolation_source", "assembly_reference"]
# Accessions and other names of a record's source.
IDENTITY_FIELDS = [
    "source_genome_id", "numeric_source_id", "source_checksum", "source_length", "source_n50", "source_contigs", "qc_pass", "source_qc", "aliases",
    "accession", "run_accession", "runAccession", "sample_accession", "sampleAccession", "assembly_accession", "assemblyAccession", "biosample",
    "run_accessions", "biosample_accessions", "assembly_accessions", "identity_resolved", "identity_conflict",
]
# Further fields that samples keep as they are.
KEPT_FIELDS = [
    "metadata_status", "country_raw", "geography_raw", "city", "host_raw", "isolation_source_raw", "hospital", "hospital_code", "publication_isolate_id", "specimen_type",
    "clinical_specimen", "study_accession", "sample_unit_id", "source_genome_ids", "raw_genome_count", "patient_id", "location",
    "mlst_status", "mlst_source", "mlst_reason", "mlst_alleles", "mlst_database_sha256", "mlst_tool_version", "mlst_assembly_sha256",
]
# Sections of a file beside its records.
SECTIONS = ["records", "parameters", "lineages", "crosswalk", "provenance", "conflicts", "exclusions", "retrieval"]

RECORD = "map<string, variant>"


def as_type(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def field(name: str, kind: str = "string") -> Column:
    """A field of a row's ``record``; null where it is absent or of another kind."""
    return as_type(F.try_element_at("record", F.lit(name)), kind)


def filled(name: str) -> Column:
    """A text field; null where it is empty."""
    return F.when(field(name) != "", field(name))


def prefixed(prefix: str, *but: str) -> Column:
    return F.map_filter("record", lambda k, _: k.startswith(prefix) & ~k.isin(*but) if but else k.startswith(prefix))


def frozen_records(spark: SparkSession, path: str, species: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, problems) of JSON files.

    A file is a list of records, or an object of ``records`` and evidence
    tables; files are read in parallel, each as one text.  ``records`` are
    (file, ordinal, record); a record without role and origin is an input.
    ``problems`` are (file, ordinal, problem), ordinal null for whole files.
    """
    top = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("v"))
    parts = top.select("file", F.col("v").isNull().alias("broken"), as_type(F.col("v"), "array<variant>").alias("rows"), as_type(F.col("v"), RECORD).alias("sections"))
    own = F.coalesce("rows", as_type(F.try_element_at("sections", F.lit("records")), "array<variant>"))
    tables = F.array(*map(F.lit, SECTIONS[2:]))
    no_list = F.exists(tables, lambda t: F.map_contains_key("sections", t) & as_type(F.try_element_at("sections", t), "array<variant>").isNull())
    no_object = F.map_contains_key("sections", F.lit("parameters")) & as_type(F.try_element_at("sections", F.lit("parameters")), RECORD).isNull()
    why = (
        F.when(F.col("broken"), "not_json")
        .when(F.size(F.array_except(F.map_keys("sections"), F.array(*map(F.lit, SECTIONS)))) > 0, "unknown_section")
        .when(own.isNull() | (F.size(own) == 0), "no_records")
        .when(no_list | no_object, "malformed_section")
    )
    judged = parts.select("file", own.alias("own"), why.alias("problem"))
    each = judged.where("problem is null").select("file", F.posexplode("own").alias("ordinal", "v")).select("file", "ordinal", as_type(F.col("v"), RECORD).alias("record"))
    named = F.schema_of_variant(F.try_element_at("record", F.lit("sample_id")))
    wrong = F.when(F.col("record").isNull(), "not_an_object").when(~F.coalesce(named == "STRING", F.lit(False)), "no_sample_id")
    if species:
        wrong = wrong.when(F.lower(filled("species")) != species.lower(), "other_species")
    each = each.withColumn("problem", wrong)
    role = F.when(field("role").isNull() & field("origin").isNull(), "input").otherwise(field("role"))
    changed = {"role": role} | ({"species": F.lit(species)} if species else {})
    given = F.map_filter("record", lambda k, _: ~k.isin(*changed))
    record = F.map_concat(given, F.map_from_arrays(F.array(*map(F.lit, changed)), F.array(*(F.to_variant_object(F.array(x)) for x in changed.values()))))
    # A changed field is stored as the first entry of a list, as only nested values become variants; it is taken out again here.
    record = F.transform_values(record, lambda k, v: F.when(k.isin(*changed), F.try_variant_get(v, "$[0]", "variant")).otherwise(v))
    problems = judged.where("problem is not null").select("file", F.lit(None).cast("int").alias("ordinal"), "problem").unionByName(each.where("problem is not null").select("file", "ordinal", "problem"))
    return each.where("problem is null").select("file", "ordinal", record.alias("record")), problems


def samples(records: DataFrame) -> DataFrame:
    """The canonical columns, ``date_raw`` and ``extras`` (JSON of the other kept fields) of each record; no field is guessed."""
    start, end, precision = D.ingest(F.coalesce(field("collection_date"), F.lit("")))
    origin = field("origin")
    listed = [F.coalesce(field(n, "array<string>"), F.array().cast("array<string>")) for n in ("run_accessions", "biosample_accessions", "assembly_accessions")]
    single = F.array_compact(F.array(*(field(n) for n in IDENTITY_FIELDS if n.lower().endswith("accession") or n == "biosample")))
    is_own = F.coalesce(S.is_input(field("role"), origin), F.lit(False))
    special = {
        "label": F.coalesce(filled("label"), S.sample_label(field("sample_id"), is_own, F.concat(single, *listed))),
        "role": F.coalesce(filled("role"), F.when(origin.isin(*V.INPUT_ORIGINS), "input").otherwise(origin)),
        "assembly_reference": F.coalesce(filled("assembly_reference"), filled("assembly")),
        "date_start": F.coalesce(filled("date_start"), start.cast("string")),
        "date_end": F.coalesce(filled("date_end"), end.cast("string")),
        "date_precision": F.coalesce(filled("date_precision"), precision),
    }
    extras = F.to_json(F.map_filter("record", lambda k, _: k.isin(*IDENTITY_FIELDS, *KEPT_FIELDS)))
    raw = F.coalesce(field("date_raw"), F.trim(F.coalesce(field("collection_date"), F.lit(""))))
    return records.select(*(special.get(n, filled(n)).alias(n) for n in SAMPLE_COLUMNS), raw.alias("date_raw"), extras.alias("extras"))


def profiles(records: DataFrame, catalogues: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, calls, problems): profiles matched to catalogues by scheme, version and database.

    ``catalogues`` are (scheme_id, scheme_version, database_version,
    database_sha256, loci).  A declared database is never mixed with another or
    an unknown one.  ``members`` are (sample_id, scheme_id, scheme_version),
    ``calls`` (sample_id, locus, allele) of called loci, none for a profile
    whose status blocks it, ``problems`` (sample_id, problem).
    """
    sha, kind = F.lower(filled("cgmlst_database_sha256")), "map<string, string>"
    none = F.create_map().cast(kind)
    taken = records.select(
        field("sample_id").alias("sample_id"), S.text(field("cgmlst_scheme")).alias("scheme"), S.scope_version(field("cgmlst_scheme_version"), sha).alias("version"), filled("cgmlst_database_version").alias("database"), sha.alias("sha"),
        F.coalesce(field("cgmlst_profile", kind), none).alias("called"), F.coalesce(field("cgmlst_novel_alleles", kind), none).alias("novel"),
        F.coalesce(field("cgmlst_ambiguous_loci", "array<string>"), F.array().cast("array<string>")).alias("ambiguous"), F.coalesce(field("cgmlst_status").isin(*V.BLOCKED_PROFILE), F.lit(False)).alias("blocked"),
    )
    ids = taken.groupBy("sample_id").agg(F.count("*").alias("rows"))
    known = catalogues.select(F.col("scheme_id").alias("scheme"), F.col("scheme_version").alias("version"), F.col("database_version").alias("other"), F.lower("database_sha256").alias("other_sha"), "loci")
    fits = (F.col("database").isNull() | F.col("other").isNull() | (F.col("database") == F.col("other"))) & F.col("sha").eqNullSafe(F.col("other_sha"))
    met = taken.join(known, ["scheme", "version"], "left").withColumn("fits", F.coalesce(fits & F.col("loci").isNotNull(), F.lit(False)))
    # A record that fits no catalogue keeps one row.
    chosen = met.groupBy("sample_id", "scheme", "version", "database", "sha", F.to_json("called").alias("_c"), F.to_json("novel").alias("_n"), "ambiguous", "blocked").agg(
        F.any_value("called").alias("called"), F.any_value("novel").alias("novel"), F.count_if("fits").alias("n"), F.max(F.when(F.col("fits"), F.col("loci"))).alias("loci")
    )
    has = (F.size("called") > 0) | (F.size("novel") > 0)
    keys = F.array_union(F.map_keys("called"), F.map_keys("novel"))
    why = (
        F.when(F.col("rows") > 1, "repeated_id")
        .when(F.col("sha").isNotNull() & ~F.col("sha").rlike("^[0-9a-f]{64}$"), "invalid_fingerprint")
        .when(F.col("n") > 1, "several_catalogues")
        .when((F.col("n") == 0) & has, "no_catalogue")
        .when(F.col("n") == 0, None)
        .when(F.arrays_overlap(F.map_keys("called"), F.map_keys("novel")), "called_and_novel")
        .when(F.arrays_overlap(keys, "ambiguous"), "ambiguous_and_called")
        .when(~F.col("blocked") & (F.size(F.array_except(keys, "loci")) > 0), "unknown_locus")
    )
    judged = chosen.join(ids, "sample_id").withColumn("problem", why)
    good = judged.where("problem is null and n = 1")
    calls = good.where("not blocked").select("sample_id", F.explode(F.concat(F.map_entries("called"), F.map_entries("novel"))).alias("e")).select("sample_id", F.col("e.key").alias("locus"), S.model_allele(F.col("e.value")).alias("allele")).where("allele is not null")
    return good.select("sample_id", F.col("scheme").alias("scheme_id"), F.col("version").alias("scheme_version")), calls, judged.where("problem is not null").select("sample_id", "problem").distinct()


def lineages(records: DataFrame) -> DataFrame:
    """A row for each kind of lineage a record has fields of, with these fields as evidence."""

    def one(kind: str, code: str) -> DataFrame:
        sha = [field(f"{kind}_{n}") for n in ("frozen_export_sha256", "export_sha256", "public_typing_export_sha256")] if kind == "cglin" else []
        known = S.typing_scope(field(f"{kind}_scheme"), field(f"{kind}_scheme_version"), field(f"{kind}_database_sha256"), *sha).isNotNull()
        version = F.when(known, S.scope_version(field(f"{kind}_scheme_version"), field(f"{kind}_database_sha256"), *sha)).otherwise(filled(f"{kind}_scheme_version"))
        rows = records.withColumn("evidence", prefixed(kind + "_")).where(F.size("evidence") > 0)
        return rows.select(
            field("sample_id").alias("sample_id"), F.lit(kind).alias("kind"), filled(f"{kind}_scheme").alias("scheme_id"), version.alias("scheme_version"), filled(f"{kind}_database_version").alias("database_version"),
            F.nullif(F.to_json(F.map_filter("record", lambda k, _: k == code)), F.lit("{}")).alias("assignment"),
            F.coalesce(filled(f"{kind}_source"), F.lit("frozen_record")).alias("assignment_method"), F.coalesce(filled(f"{kind}_status"), F.lit("unverified")).alias("resolution_status"), F.to_json("evidence").alias("evidence"),
        )

    return one("cglin", "cglin_raw").unionByName(one("hiercc", "hiercc_codes"))


def crosswalk(records: DataFrame) -> DataFrame:
    """(sample_id, resolution_status, identity): the names of each record's source; a conflict outweighs a resolution."""
    true = lambda n: F.coalesce(field(n, "boolean"), F.lit(False))
    status = F.when(true("identity_conflict"), "ambiguous").when(true("identity_resolved"), "resolved").otherwise("unresolved")
    return records.select(field("sample_id").alias("sample_id"), status.alias("resolution_status"), F.to_json(F.map_filter("record", lambda k, _: k.isin(*IDENTITY_FIELDS, "identity_candidates"))).alias("identity"))


def retrieval(records: DataFrame) -> DataFrame:
    """(sample_id, operation, source, status, evidence): where each profile came from, without the profile itself."""
    evidence = F.to_json(prefixed("cgmlst_", "cgmlst_profile", "cgmlst_novel_alleles", "cgmlst_loci"))
    return records.select(field("sample_id").alias("sample_id"), F.lit("frozen_profile").alias("operation"), F.coalesce(filled("cgmlst_source"), F.lit("frozen_record")).alias("source"), F.coalesce(filled("cgmlst_status"), F.lit("unavailable")).alias("status"), evidence.alias("evidence"))


def stored(records: DataFrame) -> DataFrame:
    """Records as a flat table: a text column for each sample column, the names of those present, and the rest as JSON."""
    present = F.filter(F.array(*map(F.lit, SAMPLE_COLUMNS)), lambda n: F.map_contains_key("record", n))
    rest = F.to_json(F.map_filter("record", lambda k, _: ~k.isin(*SAMPLE_COLUMNS)))
    return records.select(*(field(n).alias(n) for n in SAMPLE_COLUMNS), present.alias("present"), rest.alias("extra"))


def restored(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, problems) of a flat table: absent and null fields differ again; ``problems`` are (sample_id, problem)."""
    extra = as_type(F.try_parse_json("extra"), RECORD)
    names = F.array(*map(F.lit, SAMPLE_COLUMNS))
    why = (
        F.when(extra.isNull() | F.arrays_overlap(F.map_keys(extra), names), "invalid_extra")
        .when(F.col("present").isNull() | (F.size(F.array_distinct("present")) != F.size("present")) | (F.size(F.array_except("present", names)) > 0), "invalid_present")
    )
    judged = table.withColumn("problem", why)
    every = F.create_map(*(x for n in SAMPLE_COLUMNS for x in (F.lit(n), F.col(n))))
    shown = F.transform(F.filter(names, lambda n: F.array_contains("present", n)), lambda n: F.struct(n.alias("key"), F.parse_json(F.coalesce(F.to_json(F.array(F.try_element_at(every, n))), F.lit("[null]"))).alias("value")))
    record = F.map_concat(extra, F.transform_values(F.map_from_entries(shown), lambda k, v: F.try_variant_get(v, "$[0]", "variant")))
    return judged.where("problem is null").select(record.alias("record")), judged.where("problem is not null").select("sample_id", "problem")


def distance_evidence(spark: SparkSession, path: str, method: str, definition: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, problems) of JSON evidence (method, distance_definition, records), which must be of the method and definition asked for.

    Pairs keep their values as text for ``distance_problems``.
    """
    fields = ["sample_id_1", "sample_id_2", "allele_differences", "shared_called_loci", "scheme_loci", "call_overlap", "distance"]
    top = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file"), as_type(F.try_parse_json("value"), RECORD).alias("record"))
    rows = field("records", "array<variant>")
    why = F.when(F.col("record").isNull(), "not_an_object").when(~field("method").eqNullSafe(F.lit(method)) | ~field("distance_definition").eqNullSafe(F.lit(definition)), "other_method").when(filled("schema").isNotNull(), "unsupported_schema").when(rows.isNull(), "no_records")
    judged = top.select("file", rows.alias("rows"), why.alias("problem"))
    pairs = judged.where("problem is null").select("file", F.explode("rows").alias("v")).select("file", as_type(F.col("v"), RECORD).alias("record")).select("file", *(field(n).alias(n) for n in fields))
    return pairs, judged.where("problem is not null").select("file", "problem")


def distance_problems(pairs: DataFrame, loci: int) -> DataFrame:
    """(sample_id_1, sample_id_2, problem): the first rule that a pair of texts breaks, against a catalogue of ``loci`` loci.

    A pair may lack its distance; a distance given must be differences over shared loci.
    """
    whole = lambda n: F.when((F.col(n).try_cast("double") >= 0) & (F.col(n).try_cast("double") < 1e15) & (F.col(n).try_cast("double") % 1 == 0), F.col(n).try_cast("double"))
    blank = lambda n: F.col(n).isNull() | (F.col(n) == "")
    raw, shared, share, distance = whole("allele_differences"), whole("shared_called_loci"), F.col("call_overlap").try_cast("double"), F.col("distance").try_cast("double")
    pair = F.struct(F.least("sample_id_1", "sample_id_2").alias("x"), F.greatest("sample_id_1", "sample_id_2").alias("y"))
    often = pairs.groupBy(pair.alias("_p")).agg(F.count("*").alias("_n"))
    why = (
        F.when(blank("sample_id_1") | blank("sample_id_2"), "no_identifier")
        .when(F.col("sample_id_1") == F.col("sample_id_2"), "self_pair")
        .when(F.col("_n") > 1, "repeated_pair")
        .when(raw.isNull() | shared.isNull(), "invalid_count")
        .when(~blank("scheme_loci") & ~whole("scheme_loci").eqNullSafe(F.lit(float(loci))), "other_catalogue")
        .when((raw > shared) | (shared > loci), "count_out_of_range")
        .when(~blank("call_overlap") & ~F.coalesce(F.abs(share - shared / loci) <= 1e-12, F.lit(False)), "overlap_disagrees")
        .when(~blank("distance") & distance.isNull(), "invalid_distance")
        .when(~blank("distance") & ~F.isnan(distance) & ~distance.between(0, 1), "distance_out_of_range")
        .when(~blank("distance") & ~F.isnan(distance) & ~F.coalesce(F.abs(distance - F.try_divide(raw, shared)) <= 1e-12, F.lit(False)), "distance_disagrees")
    )
    keyed = pairs.withColumn("_p", pair).join(often, "_p", "left").withColumn("problem", why)
    return keyed.where("problem is not null").select("sample_id_1", "sample_id_2", "problem")

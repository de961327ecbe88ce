"""Scalar rules over columns: alleles, typing scopes, lineage codes, labels and states.

Everything here is built from JVM-side functions, so it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V


def text(c: Column) -> Column:
    """The trimmed text of a value; null is empty."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def one_of(c: Column, words: list[str]) -> Column:
    return F.lower(c).isin(words)


def folded(c: Column) -> Column:
    """White space runs become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\s+", " "))


# Alleles ------------------------------------------------------------------------------------------


def model_allele(c: Column) -> Column:
    """The stored form of an allele: missing tokens are null, every other text stays."""
    return F.when(~one_of(text(c), V.NO_ALLELE), text(c))


def comparable_allele(c: Column) -> Column:
    """The form that is compared: hashes in lower case, whole numbers above 0 without leading zeros, else null."""
    t = text(c)
    number = F.regexp_replace(t, "^0+", "")
    return F.when(t.rlike("^[0-9a-fA-F]{40}$"), F.lower(t)).when(t.rlike("^[0-9]+$") & (number != ""), number)


def effective_profile(status: Column, called: Column, novel: Column) -> Column:
    """Called and novel alleles together; null for blocked statuses, overlaps and profiles without any call."""
    more = F.coalesce(novel, F.create_map().cast("map<string,string>"))
    both = F.map_concat(called, F.map_filter(more, lambda k, _: ~F.map_contains_key(called, k)))
    clash = F.arrays_overlap(F.map_keys(called), F.map_keys(more))
    blocked = F.coalesce(status.isin(V.BLOCKED_PROFILE), F.lit(False))
    return F.when(~blocked & called.isNotNull() & ~F.coalesce(clash, F.lit(False)) & (F.size(both) > 0), both)


def locus_universe(declared: Column, profile: Column) -> Column:
    """The declared loci if they are unique and hold every called one; without a declaration the called ones."""
    keys = F.map_keys(profile)
    good = (F.size(declared) > 0) & (F.size(F.array_distinct(declared)) == F.size(declared)) & (F.size(F.array_except(keys, declared)) == 0)
    return F.when(declared.isNull(), F.sort_array(keys)).when(good, F.sort_array(declared))


# Typing scopes --------------------------------------------------------------------------------------


def scope_version(version: Column, database_sha256: Column, *exports: Column) -> Column:
    """The version, else a fingerprint of the database, else of a frozen export; null if none is known."""
    digest = F.lower(text(database_sha256))
    out = F.when(~one_of(text(version), V.NO_SCHEME), text(version)).when(digest.rlike("^[0-9a-f]{64}$"), F.concat(F.lit("sha256:"), digest))
    for e in exports:
        name = F.lower(text(e))
        out = out.when(name.rlike("^[0-9a-f]{64}$"), F.concat(F.lit("exportsha256:"), name))
    return out


def typing_scope(scheme: Column, version: Column, database_sha256: Column, *exports: Column) -> Column:
    """``scheme|version``; null unless both are known."""
    v = scope_version(version, database_sha256, *exports)
    return F.when(~one_of(text(scheme), V.NO_SCHEME) & v.isNotNull(), F.concat_ws("|", text(scheme), v))


def compatible_typing(a_scope: Column, b_scope: Column, a_sha: Column, b_sha: Column) -> Column:
    """Equal scopes (two unknown ones are equal) without two different known fingerprints."""
    a, b = F.lower(text(a_sha)), F.lower(text(b_sha))
    return a_scope.eqNullSafe(b_scope) & ~((a != "") & (b != "") & (a != b))


# Lineage codes ---------------------------------------------------------------------------------------


def lineage_parts(code: Column) -> Column:
    return F.transform(F.split(text(code), "[_,]"), lambda x: F.trim(x))


def lineage_status(code: Column) -> Column:
    """missing, malformed, complete or partial: numbers may not follow an unknown component."""
    parts = lineage_parts(code)
    state = F.aggregate(
        parts,
        F.lit("known"),
        lambda acc, x: F.when(acc == "malformed", acc)
        .when(x.rlike("^[0-9]+$"), F.when(acc == "unknown", F.lit("malformed")).otherwise(acc))
        .when(x.isin("", "-", "?", "*") | x.rlike(r"^\*[A-Za-z0-9]+$"), F.lit("unknown"))
        .otherwise(F.lit("malformed")),
    )
    resolved = F.size(F.filter(parts, lambda x: x.rlike("^[0-9]+$")))
    return (
        F.when(one_of(text(code), V.NO_CODE), "missing")
        .when((F.size(parts) > V.LINEAGE_COMPONENTS) | (state == "malformed"), "malformed")
        .when(resolved == V.LINEAGE_COMPONENTS, "complete")
        .otherwise("partial")
    )


def lineage_components(code: Column) -> Column:
    """The resolved numbers as an array; empty if the code is missing or malformed."""
    numbers = F.transform(F.filter(lineage_parts(code), lambda x: x.rlike("^[0-9]+$")), lambda x: x.cast("bigint"))
    return F.when(lineage_status(code).isin("complete", "partial"), numbers).otherwise(F.array().cast("array<bigint>"))


def lineage_group(scheme: Column, version: Column, components: Column, depth: int) -> Column:
    """The whole prefix within its scheme and version; empty if the code is shallower."""
    prefix = F.concat(F.lit("["), F.concat_ws(",", F.transform(F.slice(components, 1, depth), lambda x: x.cast("string"))), F.lit("]"))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    return F.when(F.size(components) >= depth, F.concat(F.lit("["), quoted(scheme), F.lit(","), quoted(version), F.lit(","), prefix, F.lit("]"))).otherwise("")


def hierarchy_key(scope: Column, status: Column, code: Column) -> Column:
    """A cluster code within its scope; null for blocked statuses and codes that are not numbers."""
    return F.when(scope.isNotNull() & ~one_of(text(status), V.BLOCKED_LINEAGE) & text(code).rlike("^[0-9]+$"), F.concat_ws("|", scope, text(code)))


def shared_depth(a: Column, b: Column) -> Column:
    """How many leading components agree."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.aggregate(same, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda acc, x: F.struct((acc["n"] + F.when(acc["on"] & x, 1).otherwise(0)).alias("n"), (acc["on"] & x).alias("on")), lambda acc: acc["n"])


def prefix_relation(a: Column, b: Column, level: int) -> Column:
    short = F.least(F.size(a), F.size(b))
    return (
        F.when(short < level, f"Unresolved LIN{level} prefix")
        .when(F.slice(a, 1, level) == F.slice(b, 1, level), f"Same LIN{level} prefix")
        .otherwise(f"Different LIN{level} prefixes")
    )


def prefix_depth(a: Column, b: Column) -> Column:
    """The shared depth; ``≥n`` when one code ends there unresolved, ``Not assessed`` without any component."""
    n, short = shared_depth(a, b), F.least(F.size(a), F.size(b))
    return F.when(short == 0, "Not assessed").when((n == short) & (n < V.LINEAGE_COMPONENTS), F.concat(F.lit("≥"), n.cast("string"))).otherwise(n.cast("string"))


# Names, places and states -----------------------------------------------------------------------------


def is_input(role: Column, origin: Column) -> Column:
    """Role decides before origin."""
    return F.coalesce(F.coalesce(role, origin).isin(V.INPUT_ORIGINS), F.lit(False))


def species_key(c: Column) -> Column:
    return F.lower(folded(F.regexp_replace(F.coalesce(c, F.lit("")), "_", " ")))


def strong_accessions(*fields: Column) -> Column:
    """Distinct run, sample and assembly accessions of all fields, sorted."""
    tokens = F.flatten(F.array(*(F.split(F.upper(F.coalesce(f.cast("string"), F.lit(""))), r"[;,\s]+") for f in fields)))
    return F.sort_array(F.array_distinct(F.filter(tokens, lambda x: x.rlike(V.STRONG_ACCESSION))))


def accession_kind(c: Column) -> Column:
    return F.when(c.rlike(V.RUN_ACCESSION), "run").when(c.rlike(V.SAMPLE_ACCESSION), "biosample").when(c.rlike(V.ASSEMBLY_ACCESSION), "assembly").when(c.rlike(r"^PRJ[NED][A-Z]\d+$"), "study").otherwise("other")


def sample_label(sample_id: Column, own: Column, values: Column, *names: Column) -> Column:
    """Own records keep their id; others show a run, else a sample, else an assembly accession, else a name."""
    first = lambda pattern: F.element_at(F.sort_array(F.filter(values, lambda x: x.rlike(pattern))), 1)
    got = lambda pattern: F.when(F.size(F.filter(values, lambda x: x.rlike(pattern))) > 0, first(pattern))
    plain = [F.when((text(n) != "") & ~text(n).startswith("PW_") & (text(n) != sample_id), text(n)) for n in names]
    return F.when(own & ~sample_id.startswith("PW_"), sample_id).otherwise(F.coalesce(got(V.RUN_ACCESSION), got(V.SAMPLE_ACCESSION), got(V.ASSEMBLY_ACCESSION), *plain, sample_id))


def host_state(c: Column) -> Column:
    """First letter upper case, the rest lower; null if not known."""
    t = folded(c)
    return F.when(~one_of(t, V.NO_HOST), F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 10_000))))


def state_text(c: Column) -> Column:
    t = folded(c)
    return F.when(~one_of(t, V.NO_STATE), t)


def place_state(country: Column, region: Column, city: Column, field: str) -> Column:
    """A region or city with its parents, so equal names in different countries differ."""
    value = state_text(region if field == "region" else city)
    parents = [F.coalesce(state_text(country), F.lit("Unknown country"))] + ([state_text(region)] if field == "city" else [])
    return F.when(value.isNotNull(), F.concat_ws(" / ", *parents, value))


def known_country(c: Column) -> Column:
    return state_text(c)


def digest12(*parts: Column) -> Column:
    """A short stable name for a key."""
    return F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256), 1, 12)


def export_id(sample_id: Column) -> Column:
    return F.concat(F.lit("CC_"), F.substring(F.sha2(sample_id.cast("string"), 256), 1, 16))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def is_number(c: Column) -> Column:
    return text(c).rlike("^[0-9]+$")


def country_name(raw: Column, lookup: Column) -> Column:
    """Text before a colon, ``XX - Name`` forms and two-letter codes through ``lookup`` (a map of upper-case codes and aliases)."""
    t = folded(F.split(F.coalesce(raw, F.lit("")), ":")[0])
    t = F.when(t.rlike("^[A-Z]{2} - .+"), F.substring(t, 6, 10_000)).otherwise(t)
    return F.when(~one_of(t, V.NO_STATE), F.coalesce(lookup[F.upper(t)], t))


# Sequences --------------------------------------------------------------------------------------------


def called_bases(a: Column, b: Column) -> Column:
    """How many places are A, C, G or T in both sequences."""
    return F.size(F.filter(F.zip_with(F.split(F.upper(a), ""), F.split(F.upper(b), ""), lambda x, y: F.coalesce(x.isin("A", "C", "G", "T") & y.isin("A", "C", "G", "T"), F.lit(False))), lambda ok: ok))


def base_differences(a: Column, b: Column) -> Column:
    """How many of those places differ."""
    return F.size(F.filter(F.zip_with(F.split(F.upper(a), ""), F.split(F.upper(b), ""), lambda x, y: F.coalesce(x.isin("A", "C", "G", "T") & y.isin("A", "C", "G", "T") & (x != y), F.lit(False))), lambda ok: ok))

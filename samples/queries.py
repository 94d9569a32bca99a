"""Every operator and report over the derived relations, by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samples import payloads
from samples.relations import Relations
from wardline.constants import ALL_PRIVILEGES, CATALOG, INHERITED_PRIVILEGES, SCHEMA, TABLE
from wardline.functions import cipher, key_versions, names, routine_rules
from wardline import schemas
from wardline.operators import entitlements, grants, membership, rule_tables, securables
from wardline.plans import landing as landing_job
from wardline.plans import audit, principals, protection, reports, tagging
from wardline.session import scratch_folder
from wardline.sinks import tables as sinks
from wardline.sinks.tables import append_audit, save
from wardline.sources import payloads as landed
from wardline.sources import tables as saved
from wardline.sources.lookup import privilege_lookup

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_RUN = "2024-02-01 00:00:00"
SECOND_RUN = "2024-03-01 00:00:00"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def query(run: Callable[[SparkSession, Relations], DataFrame]) -> Query:
    def over_folder(spark: SparkSession, folder: str) -> DataFrame:
        return run(spark, Relations(spark, folder))

    QUERIES[run.__name__] = over_folder
    return over_folder


def at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def comparable(df: DataFrame) -> DataFrame:
    """Lists as sorted text and times as text, so that engines can be compared by value."""

    def shown(name: str, kind: str) -> Column:
        if kind == "array<string>":
            return F.array_join(F.sort_array(name), ",").alias(name)
        if kind.startswith("timestamp"):
            return F.date_format(name, TIME_FORMAT).alias(name)
        return F.col(name)

    return df.select(*[shown(name, kind) for name, kind in df.dtypes])


def table_name(purpose: str) -> str:
    return f"{purpose}_{uuid.uuid4().hex}"


# Sources and functions


@query
def privilege_lookup_expanded(spark, r):
    """The fixed lookup, reached from every owned securable."""
    owners = grants.owned_securables(r).select(
        "identifier", "type", F.lit("ALL_PRIVILEGES").alias("privilegeType")
    )
    return grants.expand_inheritance(owners, privilege_lookup(spark))


@query
def routines_defined(spark, r):
    return saved.routines_with_definition(r["routines"])


@query
def routines_like(spark, r):
    return saved.routines_like(r["routines"], "%encrypt%")


@query
def parse_tag_payloads(spark, r):
    return comparable(landed.parse_tag_payloads(payloads.tag_payloads(r)))


@query
def parse_users(spark, r):
    return comparable(landed.parse_users(payloads.user_payloads(r)))


@query
def parse_groups(spark, r):
    return comparable(landed.parse_groups(payloads.group_payloads(r)))


@query
def function_validity(spark, r):
    return saved.routines_with_definition(r["routines"]).select(
        names.identifier("routine_catalog", "routine_schema", "routine_name").alias("identifier"),
        routine_rules.function_validity("routine_definition").alias("isFunctionValid"),
    )


@query
def secret_validity(spark, r):
    return saved.routines_with_definition(r["routines"]).select(
        names.identifier("routine_catalog", "routine_schema", "routine_name").alias("identifier"),
        routine_rules.secret_validity("routine_definition").alias("isSecretValid"),
    )


@query
def function_validity_by_table(spark, r):
    """Names and phrases that a table bans."""
    routines = saved.routines_with_definition(r["routines"])
    return rule_tables.with_function_validity(routines, r["banned_names"]).select(
        names.identifier("routine_catalog", "routine_schema", "routine_name").alias("identifier"),
        "isFunctionValid",
    )


@query
def secret_validity_by_table(spark, r):
    """Keys that a table allows."""
    routines = saved.routines_with_definition(r["routines"])
    return rule_tables.with_secret_validity(routines, r["allowed_keys"]).select(
        names.identifier("routine_catalog", "routine_schema", "routine_name").alias("identifier"),
        "isSecretValid",
    )


@query
def banned_calls(spark, r):
    """How many routines each banned name is in."""
    routines = saved.routines_with_definition(r["routines"])
    calls = rule_tables.banned_calls(routines, r["banned_names"])
    texts = routines.select(F.sha2("routine_definition", 256).alias("definition_key"))
    copies = texts.groupBy("definition_key").agg(F.count(F.lit(1)).alias("n"))
    return calls.join(copies, "definition_key").groupBy("name").agg(F.sum("n").alias("n_routines"))


@query
def dotted_names(spark, r):
    """Names that only backticks tell apart, and their parts."""
    plain = r["schemata"].select("catalog_name", "schema_name")
    catalogs = plain.select(F.concat_ws(".", "catalog_name", "schema_name").alias("a"), F.lit("x").alias("b"))
    schemata = plain.select(F.col("catalog_name").alias("a"), F.concat("schema_name", F.lit(".x")).alias("b"))
    named = catalogs.unionByName(schemata).select(names.identifier("a", "b").alias("identifier"))
    return securables.classify_securables(named).withColumns(
        {f"part{n}": names.name_part("identifier", n) for n in (1, 2, 3)}
    )


@query
def all_assets_dotted(spark, r):
    """Assets of schemata whose catalogs, or which themselves, have a dot in their name."""

    def twins(df: DataFrame, catalog: str, schema: str) -> DataFrame:
        moved = {catalog: F.concat_ws(".", catalog, schema), schema: F.lit("x")}
        kept = {schema: F.concat(schema, F.lit(".x"))}
        return df.withColumns(moved).unionByName(df.withColumns(kept))

    metadata = {name: r[name] for name in schemas.METADATA}
    for name in ("schemata", "schema_privileges"):
        metadata[name] = twins(metadata[name], *schemas.SCHEMA_KEY)
    return grants.all_assets(metadata)


@query
def classify_securable(spark, r):
    return securables.classify_securables(r["securables"]).withColumns(
        {f"part{n}": names.name_part("identifier", n) for n in (1, 2, 3)}
    )


# Grants


@query
def effective_catalog_grants(spark, r):
    return grants.effective_grants(r, CATALOG)


@query
def effective_schema_grants(spark, r):
    return grants.effective_grants(r, SCHEMA)


@query
def effective_table_grants(spark, r):
    return grants.effective_grants(r, TABLE)


@query
def expand_inheritance(spark, r):
    granted = grants.granted_securables(r).withColumnRenamed(
        "privilege_type", "privilegeType"
    )
    return grants.expand_inheritance(granted, privilege_lookup(spark))


@query
def lookup_inserted(spark, r):
    """Inheritance by a lookup that was inserted row by row into a table that was reset."""
    table = table_name("lookup")
    rows = [
        (kind, ALL_PRIVILEGES, privilege)
        for kind, privileges in INHERITED_PRIVILEGES.items()
        for privilege in privileges
    ]
    for _ in range(2):
        sinks.reset_table(spark, table, schemas.PRIVILEGE_LOOKUP)
        sinks.insert_rows(spark, table, rows)
    granted = grants.granted_securables(r).withColumnRenamed("privilege_type", "privilegeType")
    return grants.expand_inheritance(granted, saved.read_saved(spark, table))


@query
def all_assets(spark, r):
    return grants.all_assets(r)


@query
def all_assets_report(spark, r):
    return reports.all_assets_report(r, privilege_lookup(spark))


@query
def discovery_report(spark, r):
    tags = payloads.stored_tags(r)
    return comparable(reports.discovery_report(tags, r, privilege_lookup(spark)))


@query
def function_report(spark, r):
    return reports.function_report(r, privilege_lookup(spark))


@query
def reports_from_metadata_folder(spark, r):
    """The asset report over metadata that was landed in a folder and read from there."""
    folder = scratch_folder(spark, "metadata")
    for name in schemas.METADATA:
        save(r[name], f"{folder}/{name}", "errorifexists")
    return reports.all_assets_report(saved.read_metadata(spark, folder), privilege_lookup(spark))


def landed_metadata(spark: SparkSession, r: Relations, as_tables: bool = False) -> Relations:
    """All metadata relations, saved in a folder or as tables of a catalog schema, and read again."""
    source = scratch_folder(spark, "metadata")
    if as_tables:
        source = table_name("metadata")
        spark.sql(f"CREATE DATABASE {source}")
    for name in schemas.METADATA:
        save(r[name], f"{source}{'.' if as_tables else '/'}{name}", "errorifexists")
    return saved.read_metadata(spark, source)


@query
def discovery_report_from_metadata_folder(spark, r):
    tags = payloads.stored_tags(r)
    return comparable(
        reports.discovery_report(tags, landed_metadata(spark, r), privilege_lookup(spark))
    )


@query
def assets_from_metadata_tables(spark, r):
    return reports.all_assets_report(landed_metadata(spark, r, True), privilege_lookup(spark))


@query
def function_report_from_metadata_tables(spark, r):
    return reports.function_report(landed_metadata(spark, r, True), privilege_lookup(spark))


@query
def function_validity_from_metadata_folder(spark, r):
    """The validity report over two recorded runs, whose routines were landed."""
    metadata, target = landed_metadata(spark, r), scratch_folder(spark, "audit")
    plan = scratch_folder(spark, "plan")
    audit.record_audit(metadata["routines"], target, at(FIRST_RUN))
    save(audit.removal_plan(audit.read_history(spark, target)), plan, "errorifexists")
    audit.mark_removed_in_runs(spark, target, saved.read_saved(spark, plan))
    audit.record_audit(metadata["routines"], target, at(SECOND_RUN))
    return comparable(reports.function_validity_report(audit.read_history(spark, target)))


@query
def principal_report_from_access_table(spark, r):
    """The principal report over the table that the access job keeps."""
    table, folder = table_name("access"), scratch_folder(spark, "access")
    principals.refresh_access_table(
        spark, table, folder, payloads.user_payloads(r), payloads.group_payloads(r)
    )
    return reports.principal_report(saved.read_saved(spark, table))


# Routine audit


def audit_history(spark: SparkSession, r: Relations) -> DataFrame:
    """The stored history of two audit runs, the first of which has been marked already."""
    first_run, history = scratch_folder(spark, "audit"), scratch_folder(spark, "audit")
    audit.record_audit(r["routines"], first_run, at(FIRST_RUN))
    first = saved.read_saved(spark, first_run)
    append_audit(audit.mark_removed(first, audit.removal_plan(first)), history)
    audit.record_audit(r["routines"], history, at(SECOND_RUN))
    return saved.read_saved(spark, history)


@query
def routine_audit(spark, r):
    return comparable(audit.routine_audit(r["routines"], at(FIRST_RUN)))


@query
def function_validity_report(spark, r):
    return comparable(reports.function_validity_report(audit_history(spark, r)))


@query
def removal_plan(spark, r):
    return comparable(audit.removal_plan(audit_history(spark, r)))


@query
def removal_plan_history(spark, r):
    return comparable(audit.removal_plan(audit_history(spark, r), include_history=True))


@query
def audit_mark_removed(spark, r):
    history = audit_history(spark, r)
    return comparable(audit.mark_removed(history, audit.removal_plan(history)))


@query
def sink_append(spark, r):
    """Two audit runs appended to one stored history."""
    target = scratch_folder(spark, "audit")
    for run in (FIRST_RUN, SECOND_RUN):
        audit.record_audit(r["routines"], target, at(run))
    return comparable(audit.read_history(spark, target))


@query
def audit_mark_runs(spark, r):
    """A history stored by run, whose first run is marked; a run that is recorded again counts once."""
    target, plan = scratch_folder(spark, "audit"), scratch_folder(spark, "plan")
    audit.record_audit(r["routines"], target, at(FIRST_RUN))
    save(audit.removal_plan(audit.read_history(spark, target)), plan, "errorifexists")
    for _ in range(2):
        audit.record_audit(r["routines"], target, at(SECOND_RUN))
        audit.mark_removed_in_runs(spark, target, saved.read_saved(spark, plan))
    return comparable(audit.read_history(spark, target))


@query
def audit_mark_stored_plan(spark, r):
    """A stored plan is marked in a stored history; the run added after the plan stays open."""
    table, folder = table_name("audit"), scratch_folder(spark, "audit")
    audit.record_audit(r["routines"], table, at(FIRST_RUN))
    plan = f"{folder}/plan"
    save(audit.removal_plan(audit.read_history(spark, table)), plan, "errorifexists")
    audit.record_audit(r["routines"], table, at(SECOND_RUN))
    audit.mark_removed_in_table(spark, table, folder, saved.read_saved(spark, plan))
    return comparable(audit.read_history(spark, table))


# Tags


@query
def listed_securables(spark, r):
    """The securables in scope, from landed list answers."""
    return securables.enumerate_securables(landed.listed_metadata(*payloads.list_pages(r)))


@query
def refresh_tag_table(spark, r):
    """Two runs of the tag job: one finds the stored tags, the next what was scanned later."""
    table, folder = table_name("tags"), scratch_folder(spark, "tags")
    runs = ((FIRST_RUN, "stored_observations"), (SECOND_RUN, "scanned_observations"))
    for run, observations in runs:
        answers = payloads.tag_payloads(r, observations)
        tagging.refresh_tag_table(spark, table, folder, answers, r, at(run))
    return comparable(saved.read_saved(spark, table))


def land(r: Relations, observations: str, moment: str, landing: str, broken: bool = False) -> None:
    """Answers of one scan, added to the files of a landing folder."""
    answers = payloads.tag_payloads(r, observations, broken)
    landed_at = at(moment).alias("landed_at")
    save(saved.typed(answers.select("*", landed_at), schemas.LANDED_ANSWER), landing, "append")


@query
def refresh_tags_from_landing(spark, r):
    """The same two scans from a landing folder; a third run finds nothing new."""
    table, folder = table_name("tags"), scratch_folder(spark, "tags")
    landing = scratch_folder(spark, "landing")
    land(r, "stored_observations", FIRST_RUN, landing)
    landing_job.refresh_from_landing(spark, table, folder, landing, r, buckets=4)
    land(r, "scanned_observations", SECOND_RUN, landing)
    for _ in range(2):
        landing_job.refresh_from_landing(spark, table, folder, landing, r, buckets=4)
    return comparable(saved.read_saved(spark, table))


@query
def tag_answers(spark, r):
    """Every answer, those that could not be read with the reason."""
    answers = landed.tag_answers(payloads.tag_payloads(r, broken=True))
    return comparable(answers.select("identifier", "status_code", "tags", "reason"))


@query
def rejected_answers(spark, r):
    """What a run of the landing job has set aside."""
    table, folder = table_name("tags"), scratch_folder(spark, "tags")
    landing = scratch_folder(spark, "landing")
    land(r, "scanned_observations", FIRST_RUN, landing, broken=True)
    landing_job.refresh_from_landing(spark, table, folder, landing, r)
    found = landing_job.rejected_answers(spark, folder)
    return comparable(found.select("identifier", "reason", "landed_at"))


@query
def merge_tags_colocated(spark, r):
    """A bucketed tag table merged twice; its versions keep the buckets."""
    table, folder = table_name("tags"), scratch_folder(spark, "tags")
    sinks.publish_version(payloads.stored_tags(r), table, folder, ("identifier", 4))
    for _ in range(2):
        tagging.merge_into_table(spark, table, folder, payloads.scanned_tags(r))
    return comparable(saved.read_saved(spark, table))


@query
def sink_publish_version(spark, r):
    """Two versions of the tag table; the second is a merge into the first."""
    table, folder = table_name("tags"), scratch_folder(spark, "tags")
    sinks.publish_version(payloads.stored_tags(r), table, folder)
    merged = tagging.merge_tags(saved.read_saved(spark, table), payloads.scanned_tags(r))
    sinks.publish_version(merged, table, folder)
    return comparable(saved.read_saved(spark, table))


@query
def enumerate_securables(spark, r):
    return securables.enumerate_securables(r)


def collected(r: Relations, **options) -> DataFrame:
    return tagging.collect_tags(
        payloads.tag_payloads(r),
        securables.enumerate_securables(r),
        as_of=at(SECOND_RUN),
        **options,
    )


@query
def collect_tags(spark, r):
    return comparable(collected(r))


@query
def collect_tags_one_per_catalog(spark, r):
    return comparable(collected(r, one_per_catalog=True))


@query
def union_all_tags(spark, r):
    """Tags of the three levels, parsed level by level."""
    answers = landed.parse_tag_payloads(payloads.tag_payloads(r))
    by_level = [
        answers.filter(names.securable_type("identifier") == level)
        for level in (CATALOG, SCHEMA, TABLE)
    ]
    return comparable(tagging.union_tags(*by_level))


@query
def last_tagged_table(spark, r):
    return comparable(
        securables.last_tagged_table(landed.parse_tag_payloads(payloads.tag_payloads(r)))
    )


@query
def explode_tags(spark, r):
    return payloads.stored_tags(r).select("identifier", "type", F.explode("tags").alias("tag"))


@query
def merge_tags(spark, r):
    return comparable(tagging.merge_tags(payloads.stored_tags(r), payloads.scanned_tags(r)))


@query
def merge_tags_refresh_time(spark, r):
    return comparable(
        tagging.merge_tags(payloads.stored_tags(r), payloads.scanned_tags(r), refresh_time=True)
    )


@query
def merge_repeated_new_keys(spark, r):
    """A source that repeats securables the table lacks: each of its rows is added."""
    stored, scanned = payloads.stored_tags(r), payloads.scanned_tags(r)
    again = scanned.join(stored, "identifier", "left_anti")
    return comparable(tagging.merge_tags(stored, scanned.unionByName(again)))


@query
def merge_outcome(spark, r):
    return tagging.merge_tags_outcome(payloads.stored_tags(r), payloads.scanned_tags(r))


# Principals


def identities(r: Relations) -> tuple[DataFrame, DataFrame]:
    return (
        landed.parse_users(payloads.user_payloads(r)),
        landed.parse_groups(payloads.group_payloads(r)),
    )


@query
def inherited_entitlements(spark, r):
    return comparable(entitlements.inherited_entitlements(*identities(r)))


@query
def final_entitlements(spark, r):
    return comparable(entitlements.final_entitlements(*identities(r)))


@query
def entitlements_per_record(spark, r):
    """Records without an id, or with one that many share, keep to their own groups."""
    users, groups = identities(r)
    last = F.right("userId", F.lit(1))
    shared = users.withColumn("userId", F.when(last != "7", last))
    return comparable(entitlements.final_entitlements(shared, groups))


@query
def principal_access(spark, r):
    return entitlements.principal_access(*identities(r))


@query
def principal_access_uninherited(spark, r):
    return entitlements.principal_access(*identities(r), keep_uninherited=True)


@query
def principal_report(spark, r):
    return reports.principal_report(entitlements.principal_access(*identities(r)))


def teams(r: Relations) -> tuple[DataFrame, DataFrame]:
    users, groups = payloads.team_payloads(r)
    return landed.parse_users(users), landed.parse_groups(groups)


@query
def nested_groups(spark, r):
    return membership.containing_groups(teams(r)[1])


@query
def inherited_entitlements_nested(spark, r):
    return comparable(entitlements.inherited_entitlements(*teams(r), nested=True))


@query
def principal_access_nested(spark, r):
    return entitlements.principal_access(*teams(r), nested=True)


@query
def sink_overwrite(spark, r):
    """The access table written twice: the second write replaces the first."""
    target = scratch_folder(spark, "access")
    for keep_uninherited in (True, False):
        access = entitlements.principal_access(*identities(r), keep_uninherited)
        save(access, target, "overwrite")
    return saved.read_saved(spark, target)


@query
def refresh_access_table(spark, r):
    """The access job run twice: the second run replaces the first one's rows."""
    table, folder = table_name("access"), scratch_folder(spark, "access")
    answers = payloads.user_payloads(r), payloads.group_payloads(r)
    for keep_uninherited in (True, False):
        principals.refresh_access_table(spark, table, folder, *answers, keep_uninherited)
    return saved.read_saved(spark, table)


# Encryption

PROTECTED = ("ssn", "zipcode")
KEY = ("scope2", "key2")


@query
def encrypt_length(spark, r):
    hidden = cipher.encrypt_columns(r["people"], PROTECTED, r["cipher_keys"], *KEY)
    return hidden.select(
        "name",
        F.length("ssn").alias("ssn_length"),
        F.length("zipcode").alias("zipcode_length"),
    )


@query
def encrypt_roundtrip(spark, r):
    """Encrypt, store, and decrypt what was stored."""
    target = scratch_folder(spark, "people")
    protection.publish_encrypted(r["people"], PROTECTED, r["cipher_keys"], *KEY, target)
    return protection.read_decrypted(spark, target, PROTECTED, r["cipher_keys"], *KEY)


@query
def decrypt_report(spark, r):
    hidden = cipher.encrypt_columns(r["people"], PROTECTED, r["cipher_keys"], *KEY)
    shown = {"ssn": "ssn", "zipcode": "zip"}
    return cipher.decrypt_columns(hidden, shown, r["cipher_keys"], *KEY)


@query
def decrypt_wrong_key(spark, r):
    """The tolerant reader gets NULL where the key does not fit."""
    hidden = cipher.encrypt_columns(r["people"], PROTECTED, r["cipher_keys"], *KEY)
    return cipher.decrypt_columns(
        hidden, PROTECTED, r["cipher_keys"], "scope1", "key1", tolerant=True
    )


@query
def cipher_functions(spark, r):
    """The same through registered SQL functions."""
    r["cipher_keys"].createOrReplaceTempView("wardline_cipher_keys")
    cipher.register_cipher_functions(
        spark, "wardline_cipher_keys", *KEY, "wardline_encrypt", "wardline_decrypt"
    )
    return spark.sql(
        "SELECT name, wardline_decrypt(wardline_encrypt(ssn)) AS ssn,"
        " length(wardline_encrypt(zipcode)) AS zipcode_length FROM {people}",
        people=r["people"],
    )


@query
def cipher_functions_replaced(spark, r):
    """Functions registered again with another key decrypt what that key has encrypted."""
    r["cipher_keys"].createOrReplaceTempView("wardline_cipher_keys")
    for scope, key in (("scope1", "key1"), KEY):
        cipher.register_cipher_functions(
            spark, "wardline_cipher_keys", scope, key, "wardline_hide", "wardline_show"
        )
    hidden = cipher.encrypt_columns(r["people"], PROTECTED, r["cipher_keys"], *KEY)
    return spark.sql(
        "SELECT name, wardline_show(ssn) AS ssn, wardline_show(zipcode) AS zipcode FROM {hidden}",
        hidden=hidden,
    )


def shown_versions(r: Relations, most: int) -> DataFrame:
    """The keys as they were when the newest version was ``most``."""
    return r["cipher_key_versions"].where(F.col("version") <= most)


def two_batches(spark: SparkSession, r: Relations) -> str:
    """People in two batches of one table; the key was replaced between them."""
    target = scratch_folder(spark, "people")
    late = F.pmod(F.xxhash64("name"), F.lit(2)).cast("int")
    for batch in (0, 1):
        own = r["people"].where(late == batch)
        keys = shown_versions(r, batch + 1)
        protection.publish_batch(own, PROTECTED, keys, *KEY, target, batch)
    return target


@query
def decrypt_key_versions(spark, r):
    """Rows of two versions of a key, decrypted in one reading."""
    target, keys = two_batches(spark, r), shown_versions(r, 2)
    return protection.read_batches(spark, target, PROTECTED, keys, *KEY)


@query
def rotate_key(spark, r):
    """The same table after its key was replaced again; nothing is left for a second run."""
    target, keys = two_batches(spark, r), r["cipher_key_versions"]
    for _ in range(2):
        protection.rotate_key(spark, target, PROTECTED, keys, *KEY)
    used = {f"{c}_version": key_versions.version_of(c) for c in PROTECTED}
    stored = saved.read_saved(spark, target).withColumns(used).drop(protection.BATCH)
    newest = keys.where((F.col("version") == 5) | (F.col("scope") != KEY[0]))
    return key_versions.decrypt_columns(stored, PROTECTED, newest, *KEY)


@query
def decrypt_moved_version(spark, r):
    """A value whose version was changed by hand does not decrypt; the tolerant reader gets NULL."""
    keys, moved = shown_versions(r, 2), F.regexp_replace("ssn", "^v2:", "v1:")
    hidden = key_versions.encrypt_columns(r["people"], PROTECTED, keys, *KEY)
    return key_versions.decrypt_columns(
        hidden.withColumn("ssn", moved), PROTECTED, keys, *KEY, tolerant=True
    )


@query
def cipher_functions_versions(spark, r):
    """SQL functions over a key with versions read what an older version has encrypted."""
    r["cipher_key_versions"].createOrReplaceTempView("wardline_key_versions")
    key_versions.register_cipher_functions(
        spark, "wardline_key_versions", *KEY, "wardline_seal", "wardline_open"
    )
    hidden = key_versions.encrypt_columns(r["people"], ["ssn"], shown_versions(r, 1), *KEY)
    return spark.sql(
        "SELECT name, wardline_open(ssn) AS ssn, wardline_open(wardline_seal(zipcode)) AS zipcode,"
        " length(wardline_seal(zipcode)) AS zipcode_length FROM {hidden}",
        hidden=hidden,
    )

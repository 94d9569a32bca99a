"""The same queries as SQL for an independent engine, over the same derived relations."""

from __future__ import annotations

from samples.relations import with_relations

_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
_FIRST = "'2024-02-01 00:00:00.000000'"
_SECOND = "'2024-03-01 00:00:00.000000'"

_TYPE = """CASE length(identifier) - length(replace(identifier, '.', ''))
  WHEN 0 THEN 'Catalog' WHEN 1 THEN 'Schema' ELSE 'Table' END"""

_WORD = r"[\p{L}\p{N}_]"
_NO_WORD = r"[^\p{L}\p{N}_]"

# The text braces of the patterns are doubled: the queries are format strings.
# The banned names.
_FUNCTION_VALID = (
    r"regexp_matches(routine_definition,"
    r" '(^|NO_WORD)(hash|mask|md5|sha|sha1|sha2|crc32)($|NO_WORD)')"
).replace("NO_WORD", _NO_WORD.replace("{", "{{").replace("}", "}}"))

_SECRET_CALL = (
    r"secret\((''(WORD+)''|\"(WORD+)\"),[\s\p{Z}]*(''(WORD+)''|\"(WORD+)\")\)"
    .replace("WORD", _WORD)
    .replace("{", "{{")
    .replace("}", "}}")
    .replace(r"\"", '"')
)


def _group(first: int, second: int) -> str:
    return (
        f"regexp_extract(routine_definition, '{_SECRET_CALL}', {first})"
        f" || regexp_extract(routine_definition, '{_SECRET_CALL}', {second})"
    )


# The allowed scopes and keys.
_SECRET_VALID = f"""({_group(2, 3)}, {_group(5, 6)}) IN
  (('scope1', 'key1'), ('scope2', 'key2'), ('scope3', 'key3'), ('encryptionkeys', 'ssn'))"""

_ROUTINE = "routine_catalog || '.' || routine_schema || '.' || routine_name"
_AUDIT_COLUMNS = """routine_catalog, routine_schema, routine_name, routine_owner,
  routine_definition, created_by, last_altered_by"""

_VERDICTS = f"""SELECT {_AUDIT_COLUMNS},
  CASE WHEN {_FUNCTION_VALID} THEN 'invalidFunction' ELSE 'validFunction' END AS isFunctionValid,
  CASE WHEN {_SECRET_VALID} THEN 'validSecret' ELSE 'invalidSecret' END AS isSecretValid
FROM {{routines}} WHERE routine_definition IS NOT NULL"""

_AUDIT = f"""SELECT *, isFunctionValid = 'validFunction' AND isSecretValid = 'validSecret' AS isValid
FROM ({_VERDICTS})"""

_HISTORY = f"""
SELECT *, {_FIRST} AS markedAt,
  CASE WHEN isValid THEN 'notAudited' ELSE 'remove' END AS status FROM ({_AUDIT})
UNION ALL SELECT *, {_SECOND} AS markedAt, 'notAudited' AS status FROM ({_AUDIT})"""

_PLAN = f"""SELECT {_ROUTINE} AS toRemove, markedAt, 'remove' AS action,
  'DROP FUNCTION IF EXISTS `' || routine_catalog || '`.`' || routine_schema || '`.`'
    || routine_name || '`' AS statement
FROM ({_HISTORY}) WHERE NOT isValid"""


def _effective(level: str) -> str:
    relation, owner, grants, key = {
        "catalog": ("catalogs", "catalog_owner", "catalog_privileges", ["catalog_name"]),
        "schema": (
            "schemata",
            "schema_owner",
            "schema_privileges",
            ["catalog_name", "schema_name"],
        ),
        "table": (
            "tables",
            "table_owner",
            "table_privileges",
            ["table_catalog", "table_schema", "table_name"],
        ),
    }[level]
    return f"""SELECT CASE WHEN g.grantor IS NULL THEN o.{owner} ELSE g.grantee END AS principal_owner,
  CASE WHEN g.grantor IS NULL THEN 'No Explicit Permissions' ELSE g.grantee END AS principal,
  CASE WHEN g.privilege_type IS NULL THEN 'ALL_PRIVILEGES' ELSE g.privilege_type END
    AS privileges_type,
  {", ".join("o." + name for name in key)}
FROM {{{relation}}} o LEFT JOIN {{{grants}}} g
  ON {" AND ".join(f"o.{name} = g.{name}" for name in key)}"""


_OWNED = """SELECT catalog_name AS identifier, 'Catalog' AS type, catalog_owner AS principal,
  'ALL_PRIVILEGES' AS privilegeType FROM {catalogs}
UNION ALL SELECT catalog_name || '.' || schema_name, 'Schema', schema_owner, 'ALL_PRIVILEGES'
FROM {schemata}
UNION ALL SELECT table_catalog || '.' || table_schema || '.' || table_name, 'Table', table_owner,
  'ALL_PRIVILEGES' FROM {tables}"""

_GRANTED = """SELECT catalog_name AS identifier, 'Catalog' AS type, grantor, grantee,
  privilege_type AS privilegeType FROM {catalog_privileges}
UNION ALL SELECT catalog_name || '.' || schema_name, 'Schema', grantor, grantee, privilege_type
FROM {schema_privileges}
UNION ALL SELECT table_catalog || '.' || table_schema || '.' || table_name, 'Table', grantor,
  grantee, privilege_type FROM {table_privileges}"""

_ALL_ASSETS = f"""SELECT * FROM ({_OWNED})
UNION SELECT identifier, type, grantee, privilegeType FROM ({_GRANTED})"""


def _inherit(rows: str) -> str:
    return f"""SELECT a.*, l.privilegeInheritance FROM ({rows}) a
LEFT JOIN {{privilege_lookup}} l
  ON lower(a.type) = lower(l.type) AND a.privilegeType = l.privilegeType"""


def _tags(observations: str) -> str:
    """Tags of a table as sorted text, with the latest time."""
    return f"""SELECT identifier, {_TYPE} AS type,
  string_agg(DISTINCT tag, ',' ORDER BY tag) AS tags, max(ts) AS lastCheckedAt
FROM {{{observations}}} GROUP BY identifier"""


_DISCOVERY = f"""SELECT m.identifier, m.type, m.tags, {_TIME.format("m.lastCheckedAt")} AS lastCheckedAt,
  unnest(string_split(m.tags, ',')) AS discoveryTags,
  h.principal_owner, h.principal, h.privileges_type AS privilegeType
FROM ({_tags("stored_observations")}) m LEFT JOIN (
  SELECT 'Catalog' AS level, catalog_name AS name, principal_owner, principal, privileges_type
  FROM ({_effective("catalog")})
  UNION ALL
  SELECT 'Schema', catalog_name || '.' || schema_name, principal_owner, principal, privileges_type
  FROM ({_effective("schema")})
  UNION ALL
  SELECT 'Table', table_catalog || '.' || table_schema || '.' || table_name, principal_owner,
    principal, privileges_type
  FROM ({_effective("table")})) h ON h.level = m.type AND h.name = m.identifier"""

_FUNCTIONS = f"""SELECT {_ROUTINE.replace("routine_", "o.routine_")} AS identifier,
  o.routine_owner AS principalOwner,
  CASE WHEN g.grantee IS NULL THEN 'ALL_PRIVILEGES' ELSE g.privilege_type END AS privilegeType,
  o.routine_type, o.routine_body, o.routine_definition,
  g.grantee AS permissionTo, g.grantor AS permissionFrom, 'Function' AS type
FROM {{routines}} o LEFT JOIN {{routine_privileges}} g
  ON o.routine_catalog = g.routine_catalog AND o.routine_schema = g.routine_schema
    AND o.routine_name = g.routine_name"""

# Answers that fail are those for names ending in 7.
def _parsed(observations: str) -> str:
    return f"""SELECT identifier, type, tags FROM ({_tags(observations)})
WHERE identifier IN (SELECT identifier FROM {{securables}}) AND right(identifier, 1) <> '7'"""


_PARSED_TAGS = _parsed("scanned_observations")

_IN_SCOPE = """SELECT catalog_name AS identifier, 'Catalog' AS type
FROM {catalogs} WHERE catalog_type <> 'DELTASHARING_CATALOG'
UNION ALL SELECT s.catalog_name || '.' || s.schema_name, 'Schema'
FROM {schemata} s JOIN {catalogs} c ON s.catalog_name = c.catalog_name
WHERE catalog_type <> 'DELTASHARING_CATALOG'
UNION ALL SELECT table_catalog || '.' || table_schema || '.' || table_name, 'Table'
FROM {tables} t JOIN {catalogs} c ON t.table_catalog = c.catalog_name
WHERE catalog_type <> 'DELTASHARING_CATALOG'"""

_COLLECTED = f"""SELECT identifier, type, tags, {_SECOND} AS lastCheckedAt FROM ({_PARSED_TAGS})
WHERE identifier IN (SELECT identifier FROM ({_IN_SCOPE}))"""

_TWO_RUNS = f"""SELECT identifier, coalesce(l.type, m.type) AS type,
  coalesce(l.tags, m.tags) AS tags,
  CASE WHEN m.identifier IS NULL THEN {_SECOND} ELSE {_FIRST} END AS lastCheckedAt
FROM ({_parsed("stored_observations")}) m
FULL JOIN ({_parsed("scanned_observations")}) l USING (identifier)
WHERE identifier IN (SELECT identifier FROM ({_IN_SCOPE}))"""

_LAST_TABLE = f"""SELECT max(identifier) AS identifier FROM ({_PARSED_TAGS}) WHERE type = 'Table'
GROUP BY split_part(identifier, '.', 1)"""

_MERGED = f"""SELECT coalesce(m.identifier, l.identifier) AS identifier,
  coalesce(m.type, l.type) AS type,
  CASE WHEN m.identifier IS NULL OR l.lastCheckedAt >= m.lastCheckedAt THEN l.tags ELSE m.tags END
    AS tags, m.lastCheckedAt AS stored_time, l.lastCheckedAt AS scanned_time,
  CASE WHEN m.identifier IS NULL THEN 'insert' WHEN l.identifier IS NULL THEN 'keep'
    WHEN l.lastCheckedAt >= m.lastCheckedAt THEN 'update' ELSE 'stale' END AS outcome
FROM ({_tags("stored_observations")}) m
FULL JOIN ({_tags("scanned_observations")}) l ON m.identifier = l.identifier"""

_MERGED_TAGS = f"""SELECT identifier, type, tags,
  {_TIME.format("coalesce(stored_time, scanned_time)")} AS lastCheckedAt FROM ({_MERGED})"""

_INHERITED = """SELECT DISTINCT g.id, e.value FROM {user_groups} g
JOIN {group_entitlements} e ON g.display = e.displayname"""

_FINAL = f"""SELECT id, value FROM {{user_entitlements}} UNION {_INHERITED}"""


def _listed(rows: str, key: str, value: str) -> str:
    return f"SELECT {key}, string_agg({value}, ',' ORDER BY {value}) AS list FROM ({rows}) GROUP BY 1"


def _final(shown_id: str) -> str:
    """Entitlements of each user record, found by its own id and shown under another."""
    return f"""SELECT u.displayname AS displayName, u.username AS userName,
  coalesce(g.list, '') AS groups, coalesce(e.list, '') AS entitlements, {shown_id} AS userId,
  coalesce(i.list, '') AS inherited_entitlements, coalesce(f.list, '') AS final_entitlements
FROM {{users}} u
LEFT JOIN ({_listed("SELECT * FROM {user_groups}", "id", "display")}) g ON u.id = g.id
LEFT JOIN ({_listed("SELECT * FROM {user_entitlements}", "id", "value")}) e ON u.id = e.id
LEFT JOIN ({_listed(_INHERITED, "id", "value")}) i ON u.id = i.id
LEFT JOIN ({_listed(_FINAL, "id", "value")}) f ON u.id = f.id"""


def _access(only_inheriting: bool) -> str:
    condition = f"WHERE u.id IN (SELECT id FROM ({_INHERITED}))" if only_inheriting else ""
    return f"""SELECT DISTINCT u.username AS userName, g.display AS Groups, f.value AS entitlements
FROM {{users}} u JOIN {{user_groups}} g ON u.id = g.id JOIN ({_FINAL}) f ON u.id = f.id {condition}"""


_ABOVE = """above AS (
  SELECT display AS "group", displayname AS above FROM {team_members}
  WHERE display IN (SELECT displayname FROM {teams})
  UNION SELECT a."group", m.displayname FROM above a JOIN {team_members} m ON m.display = a.above)"""

_NESTED = f"""{_ABOVE},
passed AS (SELECT * FROM {{team_entitlements}}
  UNION SELECT a."group", e.value FROM above a JOIN {{team_entitlements}} e ON e.displayname = a.above),
inherited AS (SELECT DISTINCT id, value FROM {{team_users}} JOIN passed ON display = displayname)"""

# Answers for names ending in 5 are cut off, in 7 they failed, in 9 they are empty.
_REASON = """CASE right(identifier, 1) WHEN '7' THEN 'status 500' WHEN '9' THEN 'no answer'
  WHEN '5' THEN 'malformed' END"""


# Names and phrases of a table, as whole words.
_CALLS = (
    r"""SELECT name, routine_catalog, routine_schema, routine_name FROM {routines} JOIN {banned_names}
  ON routine_definition IS NOT NULL AND contains(routine_definition, name)
    AND regexp_matches(routine_definition, '(^|NO_WORD)' || regexp_escape(name) || '($|NO_WORD)')"""
).replace("NO_WORD", _NO_WORD.replace("{", "{{").replace("}", "}}"))

_DOTTED = """SELECT '`' || catalog_name || '.' || schema_name || '`.x' AS identifier,
  catalog_name || '.' || schema_name AS part1, 'x' AS part2 FROM {schemata}
UNION ALL SELECT catalog_name || '.`' || schema_name || '.x`', catalog_name, schema_name || '.x'
FROM {schemata}"""


def _cipher_length(column: str) -> str:
    # Twelve bytes of nonce and sixteen of tag, then four characters for every three bytes.
    return f"CAST(4 * ceil((28 + strlen({column})) / 3.0) AS INTEGER)"


ORACLE = {
    "privilege_lookup_expanded": _inherit(
        f"SELECT identifier, type, privilegeType FROM ({_OWNED})"
    ),
    "routines_defined": f"SELECT {_AUDIT_COLUMNS} FROM {{routines}}"
    " WHERE routine_definition IS NOT NULL",
    "routines_like": """SELECT routine_catalog, routine_schema, routine_name, routine_owner,
  routine_definition, created, created_by, last_altered_by
FROM {routines} WHERE routine_name LIKE '%encrypt%'""",
    "parse_tag_payloads": f"SELECT identifier, tags FROM ({_PARSED_TAGS})",
    "parse_users": f"""SELECT u.displayname AS displayName, u.username AS userName,
  coalesce(g.list, '') AS groups, coalesce(e.list, '') AS entitlements, u.id AS userId
FROM {{users}} u
LEFT JOIN ({_listed("SELECT * FROM {user_groups}", "id", "display")}) g ON u.id = g.id
LEFT JOIN ({_listed("SELECT * FROM {user_entitlements}", "id", "value")}) e ON u.id = e.id""",
    "parse_groups": f"""SELECT n.displayname AS displayName, coalesce(m.list, '') AS members,
  coalesce(e.list, '') AS entitlements, 'g-' || n.displayname AS groupId
FROM {{user_groups_named}} n
LEFT JOIN ({_listed("SELECT * FROM {group_members}", "displayname", "display")}) m
  ON n.displayname = m.displayname
LEFT JOIN ({_listed("SELECT * FROM {group_entitlements}", "displayname", "value")}) e
  ON n.displayname = e.displayname""",
    "function_validity": f"SELECT {_ROUTINE} AS identifier, isFunctionValid FROM ({_VERDICTS})",
    "secret_validity": f"SELECT {_ROUTINE} AS identifier, isSecretValid FROM ({_VERDICTS})",
    "function_validity_by_table": f"""SELECT {_ROUTINE} AS identifier,
  CASE WHEN (routine_catalog, routine_schema, routine_name) IN
      (SELECT (routine_catalog, routine_schema, routine_name) FROM ({_CALLS}))
    THEN 'invalidFunction' ELSE 'validFunction' END AS isFunctionValid
FROM {{routines}} WHERE routine_definition IS NOT NULL""",
    "secret_validity_by_table": f"""SELECT {_ROUTINE} AS identifier,
  CASE WHEN ({_group(2, 3)}, {_group(5, 6)}) IN (SELECT (scope, key) FROM {{allowed_keys}})
    THEN 'validSecret' ELSE 'invalidSecret' END AS isSecretValid
FROM {{routines}} WHERE routine_definition IS NOT NULL""",
    "banned_calls": f"SELECT name, count(*) AS n_routines FROM ({_CALLS}) GROUP BY name",
    "dotted_names": f"SELECT *, 'Schema' AS type, '' AS part3 FROM ({_DOTTED})",
    "all_assets_dotted": f"""SELECT * FROM ({_ALL_ASSETS}) WHERE type <> 'Schema'
UNION SELECT '`' || identifier || '`.x', type, principal, privilegeType
FROM ({_ALL_ASSETS}) WHERE type = 'Schema'
UNION SELECT replace(identifier, '.', '.`') || '.x`', type, principal, privilegeType
FROM ({_ALL_ASSETS}) WHERE type = 'Schema'""",
    "classify_securable": f"""SELECT identifier, {_TYPE} AS type,
  split_part(identifier, '.', 1) AS part1, split_part(identifier, '.', 2) AS part2,
  split_part(identifier, '.', 3) AS part3 FROM {{securables}}""",
    "effective_catalog_grants": _effective("catalog"),
    "effective_schema_grants": _effective("schema"),
    "effective_table_grants": _effective("table"),
    "expand_inheritance": _inherit(_GRANTED),
    "lookup_inserted": _inherit(_GRANTED),
    "all_assets": _ALL_ASSETS,
    "all_assets_report": _inherit(_ALL_ASSETS),
    "discovery_report": _inherit(_DISCOVERY),
    "function_report": _inherit(_FUNCTIONS),
    "routine_audit": f"SELECT *, {_FIRST} AS markedAt, 'notAudited' AS status FROM ({_AUDIT})",
    "function_validity_report": f"SELECT *, markedAt AS lastCheckedAt FROM ({_HISTORY})",
    "removal_plan": f"{_PLAN} AND status = 'notAudited'",
    "removal_plan_history": _PLAN,
    "audit_mark_removed": f"""SELECT * REPLACE (CASE WHEN isValid THEN status ELSE 'remove' END AS status)
FROM ({_HISTORY})""",
    "sink_append": f"SELECT * REPLACE ('notAudited' AS status) FROM ({_HISTORY})",
    "reports_from_metadata_folder": _inherit(_ALL_ASSETS),
    "audit_mark_stored_plan": _HISTORY,
    "audit_mark_runs": _HISTORY,
    "discovery_report_from_metadata_folder": _inherit(_DISCOVERY),
    "assets_from_metadata_tables": _inherit(_ALL_ASSETS),
    "function_report_from_metadata_tables": _inherit(_FUNCTIONS),
    "function_validity_from_metadata_folder": f"SELECT *, markedAt AS lastCheckedAt FROM ({_HISTORY})",
    "principal_report_from_access_table": f"""SELECT userName AS Principal, Groups,
  entitlements AS workspaceAccess FROM ({_access(only_inheriting=True)})""",
    "refresh_tags_from_landing": _TWO_RUNS,
    "merge_tags_colocated": _MERGED_TAGS,
    "tag_answers": f"""SELECT identifier, CASE WHEN right(identifier, 1) = '7' THEN 500 ELSE 200 END
    AS status_code,
  CASE WHEN {_REASON} IS NULL THEN tags END AS tags, {_REASON} AS reason
FROM {{securables}} LEFT JOIN ({_tags("scanned_observations")}) USING (identifier)""",
    "rejected_answers": f"""SELECT identifier, {_REASON} AS reason, {_FIRST} AS landed_at
FROM {{securables}} WHERE {_REASON} IS NOT NULL""",
    "nested_groups": f"""WITH RECURSIVE {_ABOVE}
SELECT * FROM above WHERE "group" <> above""",
    "inherited_entitlements_nested": f"""WITH RECURSIVE {_NESTED}
SELECT id AS userId, list AS inherited_entitlements
FROM ({_listed("SELECT * FROM inherited", "id", "value")})""",
    "principal_access_nested": f"""WITH RECURSIVE {_NESTED}
SELECT DISTINCT u.username AS userName, g.display AS Groups, f.value AS entitlements
FROM {{users}} u JOIN {{team_users}} g ON u.id = g.id
JOIN (SELECT id, value FROM {{user_entitlements}} UNION SELECT id, value FROM inherited) f ON u.id = f.id
WHERE u.id IN (SELECT id FROM inherited)""",
    "enumerate_securables": _IN_SCOPE,
    "listed_securables": _IN_SCOPE,
    "refresh_tag_table": _TWO_RUNS,
    "refresh_access_table": _access(only_inheriting=True),
    "collect_tags": _COLLECTED,
    "collect_tags_one_per_catalog": f"""SELECT * FROM ({_COLLECTED})
WHERE type <> 'Table' OR identifier IN ({_LAST_TABLE})""",
    "union_all_tags": f"SELECT identifier, tags FROM ({_PARSED_TAGS})",
    "last_tagged_table": f"""SELECT identifier, tags FROM ({_PARSED_TAGS})
WHERE identifier IN ({_LAST_TABLE})""",
    "explode_tags": f"SELECT DISTINCT identifier, {_TYPE} AS type, tag FROM {{stored_observations}}",
    "merge_tags": _MERGED_TAGS,
    "merge_repeated_new_keys": f"""{_MERGED_TAGS}
UNION ALL SELECT identifier, type, tags, {_TIME.format("scanned_time")} FROM ({_MERGED})
WHERE outcome = 'insert'""",
    "sink_publish_version": _MERGED_TAGS,
    "merge_tags_refresh_time": f"""SELECT identifier, type, tags,
  {_TIME.format("CASE WHEN outcome IN ('insert', 'update') THEN scanned_time ELSE stored_time END")}
    AS lastCheckedAt FROM ({_MERGED})""",
    "merge_outcome": f"SELECT identifier, outcome FROM ({_MERGED})",
    "inherited_entitlements": f"""SELECT id AS userId, list AS inherited_entitlements
FROM ({_listed(_INHERITED, "id", "value")})""",
    "final_entitlements": _final("u.id"),
    "entitlements_per_record": _final("nullif(right(u.id, 1), '7')"),
    "principal_access": _access(only_inheriting=True),
    "principal_access_uninherited": _access(only_inheriting=False),
    "principal_report": f"""SELECT userName AS Principal, Groups, entitlements AS workspaceAccess
FROM ({_access(only_inheriting=True)})""",
    "sink_overwrite": _access(only_inheriting=True),
    "encrypt_length": f"""SELECT name, {_cipher_length("ssn")} AS ssn_length,
  {_cipher_length("zipcode")} AS zipcode_length FROM {{people}}""",
    "encrypt_roundtrip": "SELECT name, ssn, zipcode FROM {people}",
    "decrypt_report": "SELECT name, ssn, zipcode AS zip FROM {people}",
    "decrypt_wrong_key": """SELECT name, CAST(NULL AS VARCHAR) AS ssn, CAST(NULL AS VARCHAR) AS zipcode
FROM {people}""",
    "cipher_functions": f"""SELECT name, ssn, {_cipher_length("zipcode")} AS zipcode_length
FROM {{people}}""",
    "cipher_functions_replaced": "SELECT name, ssn, zipcode FROM {people}",
    "decrypt_key_versions": "SELECT name, ssn, zipcode FROM {people}",
    "rotate_key": """SELECT name, ssn, zipcode, CAST(5 AS BIGINT) AS ssn_version,
  CAST(5 AS BIGINT) AS zipcode_version FROM {people}""",
    "decrypt_moved_version": "SELECT name, CAST(NULL AS VARCHAR) AS ssn, zipcode FROM {people}",
    "cipher_functions_versions": """SELECT name, ssn, zipcode,
  CAST(3 + 4 * ceil((28 + strlen(zipcode)) / 3.0) AS INTEGER) AS zipcode_length FROM {people}""",
}


def oracle_queries() -> dict[str, str]:
    return {name: with_relations(text) for name, text in ORACLE.items()}

"""Metadata relations as SQL that Spark and DuckDB both accept.

Every relation covers all rows of the tables it is derived from. Cases the tables lack on
their own, such as a securable without grants, come from mapping rows to neighbouring keys.
A ``{name}`` refers to a given table or to an earlier relation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_ROUTINE_NAME = """CASE WHEN doc_id % 3 = 0 THEN 'encrypt_' WHEN doc_id % 3 = 1 THEN 'Encrypt_'
      ELSE 'decrypt_' END || CAST(doc_id AS VARCHAR(20))"""

_TABLE_NAME = "r_name || '.' || n_name || '.' || c_name"

_LOCATED_NATION = "({nation} JOIN {region} ON n_regionkey = r_regionkey)"

RELATIONS = {
    "catalogs": """
SELECT r_name AS catalog_name, 'owner_' || lower(r_name) AS catalog_owner,
  CASE WHEN r_regionkey = 3 THEN 'DELTASHARING_CATALOG' ELSE 'MANAGED_CATALOG' END AS catalog_type
FROM {region}""",
    "schemata": f"""
SELECT r_name AS catalog_name, n_name AS schema_name, 'owner_' || lower(n_name) AS schema_owner
FROM {_LOCATED_NATION}""",
    "tables": f"""
SELECT r_name AS table_catalog, n_name AS table_schema, c_name AS table_name,
  'owner_' || lower(c_mktsegment) AS table_owner
FROM {{customer}} JOIN {_LOCATED_NATION} ON c_nationkey = n_nationkey""",
    # The last region's grants go to the first one: it has none of its own.
    "catalog_privileges": """
SELECT CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'admin' END AS grantor, s_name AS grantee,
  r_name AS catalog_name,
  CASE s_suppkey % 3 WHEN 0 THEN 'ALL_PRIVILEGES' WHEN 1 THEN 'USE CATALOG' ELSE 'CREATE SCHEMA' END
    AS privilege_type
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
  JOIN {region} ON r_regionkey = n_regionkey % 4""",
    # Parts spread over the first twenty nations: the others have no grants.
    "schema_privileges": f"""
SELECT CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 'admin' END AS grantor,
  'grp_' || p_brand AS grantee, r_name AS catalog_name, n_name AS schema_name,
  CASE p_size % 3 WHEN 0 THEN 'ALL_PRIVILEGES' WHEN 1 THEN 'USE SCHEMA' ELSE 'CREATE TABLE' END
    AS privilege_type
FROM {{part}} JOIN {_LOCATED_NATION} ON n_nationkey = p_partkey % 20""",
    # Every tenth customer's orders go to the one before: those tables have no grants.
    "table_privileges": f"""
SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'admin' END AS grantor,
  'grp_' || o_orderpriority AS grantee,
  r_name AS table_catalog, n_name AS table_schema, c_name AS table_name,
  CASE o_orderstatus WHEN 'F' THEN 'SELECT' WHEN 'O' THEN 'MODIFY' ELSE 'ALL_PRIVILEGES' END
    AS privilege_type
FROM {{orders}}
  JOIN {{customer}} ON c_custkey = o_custkey - CASE WHEN o_custkey % 10 = 9 THEN 1 ELSE 0 END
  JOIN {_LOCATED_NATION} ON c_nationkey = n_nationkey""",
    # Definitions carry the whole document as a comment.
    "routines": f"""
SELECT r_name AS routine_catalog, n_name AS routine_schema, {_ROUTINE_NAME} AS routine_name,
  'owner_' || lang AS routine_owner, 'FUNCTION' AS routine_type,
  CASE WHEN doc_id % 2 = 0 THEN 'SQL' ELSE 'EXTERNAL' END AS routine_body,
  CASE doc_id % 16
    WHEN 0 THEN NULL
    WHEN 1 THEN 'base64(aes_encrypt(value, secret(''scope1'',''key1'')))'
    WHEN 2 THEN 'cast(aes_decrypt(unbase64(value), secret("encryptionkeys", "ssn")) as string)'
    WHEN 3 THEN 'sha2(value, 256)'
    WHEN 4 THEN 'mask(aes_encrypt(value, secret(''scope2'',''key2'')))'
    WHEN 5 THEN 'aes_encrypt(value, secret(''scope1'',''key2''))'
    WHEN 6 THEN 'xxhash64(aes_encrypt(value, secret(''scope3'',''key3'')))'
    WHEN 7 THEN 'MD5(aes_encrypt(value, secret(''scope3'',''key3'')))'
    WHEN 8 THEN 'aes_encrypt(secret(''bad'',''k''), secret(''scope1'',''key1''))'
    WHEN 9 THEN 'aes_encrypt(value, secret( ''scope1'',''key1''))'
    WHEN 10 THEN 'aes_encrypt(value, secret(scope1,key1))'
    WHEN 11 THEN 'hashé(aes_encrypt(value, secret(''scope1'',  ''key1'')))'
    WHEN 12 THEN 'aes_encrypt(mask_x, secret(''scopé'',''key1''))'
    WHEN 13 THEN 'secret(''scope1",''key1'') secret("scope2",''key2'')'
    WHEN 14 THEN 'aes_encrypt(value, secret(''scope2'',''key2'')) -- was: md5'
    ELSE 'crc32(value)' END || ' /* ' || text || ' */' AS routine_definition,
  '2024-01-01 ' || lpad(CAST(n_chars % 24 AS VARCHAR(2)), 2, '0') || ':00:00' AS created,
  source AS created_by, lang AS last_altered_by
FROM {{documents}} JOIN {_LOCATED_NATION} ON n_nationkey = doc_id % 25""",
    "routine_privileges": f"""
SELECT r_name AS routine_catalog, n_name AS routine_schema, {_ROUTINE_NAME} AS routine_name,
  'team_' || CAST(quality AS VARCHAR(20)) AS grantee, 'admin' AS grantor,
  CASE WHEN toxic = 1 THEN 'ALL_PRIVILEGES' ELSE 'EXECUTE' END AS privilege_type
FROM {{labels}} JOIN {_LOCATED_NATION} ON n_nationkey = doc_id % 25""",
    # The latest time of each kind of event of each user, so that no later step depends on how
    # many events a user has.
    "activity": """
SELECT user_id, event_type, value < 50 AS usual, max(ts) AS ts
FROM {events} GROUP BY user_id, event_type, value < 50""",
    # Tag observations: what is stored, and what a later scan finds. Customers, nations and
    # regions missing on either side, and times that run both ways, give every merge outcome.
    "stored_observations": f"""
SELECT {_TABLE_NAME} AS identifier, event_type AS tag,
  CASE WHEN event_type IN ('error', 'purchase') THEN ts - INTERVAL '30' DAY ELSE ts END AS ts
FROM {{activity}}
  JOIN {{customer}} ON c_custkey = user_id - CASE WHEN user_id % 4 = 1 THEN 1 ELSE 0 END
  JOIN {_LOCATED_NATION} ON c_nationkey = n_nationkey
UNION ALL
SELECT r_name || '.' || n_name, event_type, ts
FROM {{activity}} JOIN {_LOCATED_NATION} ON n_nationkey = user_id % 13 * 2
UNION ALL
SELECT r_name, event_type, ts FROM {{activity}} JOIN {{region}} ON r_regionkey = user_id % 5""",
    "scanned_observations": f"""
SELECT {_TABLE_NAME} AS identifier,
  CASE WHEN usual THEN event_type ELSE 'big_' || event_type END AS tag,
  CASE WHEN event_type IN ('view', 'click') THEN ts - INTERVAL '30' DAY ELSE ts END AS ts
FROM {{activity}}
  JOIN {{customer}} ON c_custkey = user_id + CASE WHEN user_id % 4 = 2 THEN 1 ELSE 0 END
  JOIN {_LOCATED_NATION} ON c_nationkey = n_nationkey
UNION ALL
SELECT r_name || '.' || n_name, event_type || '_seen', ts
FROM {{activity}} JOIN {_LOCATED_NATION} ON n_nationkey = user_id % 8 * 3
UNION ALL
SELECT r_name, event_type || '_seen', ts
FROM {{activity}} JOIN {{region}} ON r_regionkey = user_id % 4""",
    "securables": """
SELECT catalog_name AS identifier FROM {catalogs}
UNION ALL SELECT catalog_name || '.' || schema_name FROM {schemata}
UNION ALL SELECT table_catalog || '.' || table_schema || '.' || table_name FROM {tables}""",
    "users": """
SELECT CAST(c_custkey AS VARCHAR(20)) AS id, c_name AS username, c_mktsegment AS displayname
FROM {customer}""",
    # Every tenth customer's orders go to the one before: those users are in no group.
    "user_groups": """
SELECT DISTINCT
  CAST(o_custkey - CASE WHEN o_custkey % 10 = 9 THEN 1 ELSE 0 END AS VARCHAR(20)) AS id,
  CASE WHEN o_custkey % 7 = 1 THEN '5-LOW' ELSE o_orderpriority END AS display
FROM {orders}""",
    # Every fourth customer's orders go to the one before: those users have nothing of their own.
    "user_entitlements": """
SELECT DISTINCT
  CAST(o_custkey - CASE WHEN o_custkey % 4 = 3 THEN 1 ELSE 0 END AS VARCHAR(20)) AS id,
  CASE o_orderstatus WHEN 'F' THEN 'workspace-access' WHEN 'O' THEN 'sql-access'
    ELSE 'allow-cluster-create' END AS value
FROM {orders}""",
    "user_groups_named": """
SELECT DISTINCT display AS displayname FROM {user_groups}""",
    # Orders of the last priority go to the one before: that group passes on nothing.
    "group_entitlements": """
SELECT DISTINCT
  CASE o_orderpriority WHEN '5-LOW' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS displayname,
  CASE o_orderstatus WHEN 'P' THEN 'group-only' ELSE 'workspace-access' END AS value
FROM {orders}""",
    "group_members": """
SELECT DISTINCT o_orderpriority AS displayname, c_mktsegment AS display
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # Teams within teams: a tree of suppliers, closed to a cycle at its top; some members are no teams.
    "teams": """
SELECT s_name AS displayname FROM {supplier}""",
    "team_members": """
SELECT o.s_name AS displayname, i.s_name AS display
FROM {supplier} i JOIN {supplier} o
  ON o.s_suppkey = CAST(floor(i.s_suppkey / 2) AS BIGINT) + CASE WHEN i.s_suppkey = 1 THEN 4 ELSE 0 END
UNION ALL
SELECT s_name, n_name FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "team_entitlements": """
SELECT s_name AS displayname, 'on-' || lower(n_name) AS value
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "team_users": """
SELECT CAST(c_custkey AS VARCHAR(20)) AS id, s_name AS display
FROM {customer} JOIN {supplier} ON s_suppkey = CAST(floor(c_custkey / 15) AS BIGINT)""",
    "people": """
SELECT c_name AS name,
  lpad(CAST(c_custkey % 1000 AS VARCHAR(20)), 3, '0') || '-'
    || lpad(CAST(c_custkey % 997 AS VARCHAR(20)), 3, '0') || '-'
    || lpad(CAST(c_custkey % 9973 AS VARCHAR(20)), 4, '0') AS ssn,
  lpad(CAST(c_custkey * 31 % 99991 AS VARCHAR(20)), 5, '0') || '-'
    || lpad(CAST(c_nationkey AS VARCHAR(20)), 5, '0') AS zipcode
FROM {customer}""",
    "cipher_keys": """
SELECT 'scope' || CAST(r_regionkey AS VARCHAR(20)) AS scope,
  'key' || CAST(r_regionkey AS VARCHAR(20)) AS key, md5(r_name) AS secret
FROM {region}""",
    "cipher_key_versions": """
SELECT 'scope2' AS scope, 'key2' AS key, r_regionkey + 1 AS version, md5(r_name) AS secret
FROM {region}
UNION ALL
SELECT 'scope1', 'key1', r_regionkey + 1, md5(upper(r_name) || r_name) FROM {region}""",
    "banned_names": """
SELECT DISTINCT lang AS name FROM {documents} WHERE lang IS NOT NULL
UNION
SELECT r_name || '.' || n_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
UNION
SELECT * FROM (VALUES ('hash'), ('mask'), ('md5'), ('sha'), ('sha1'), ('sha2'), ('crc32'),
  ('aes_encrypt(mask_x'), ('-- was: md5'), ('mask(')) AS v(name)""",
    "allowed_keys": """
SELECT scope, key FROM {cipher_keys}
UNION ALL
SELECT 'encryptionkeys', 'ssn' FROM {documents} WHERE source = 'src0'""",
    # The rows of the lookup.
    "privilege_lookup": """
SELECT * FROM (VALUES ('Catalog', 'ALL_PRIVILEGES', 'USE CATALOG'),
  ('Catalog', 'ALL_PRIVILEGES', 'USE SCHEMA'), ('Catalog', 'ALL_PRIVILEGES', 'SELECT'),
  ('Catalog', 'ALL_PRIVILEGES', 'MODIFY'), ('Catalog', 'ALL_PRIVILEGES', 'EXECUTE'),
  ('Catalog', 'ALL_PRIVILEGES', 'READ VOLUME'), ('Catalog', 'ALL_PRIVILEGES', 'WRITE VOLUME'),
  ('Catalog', 'ALL_PRIVILEGES', 'CREATE SCHEMA'), ('Catalog', 'ALL_PRIVILEGES', 'CREATE TABLE'),
  ('Catalog', 'ALL_PRIVILEGES', 'CREATE FUNCTION'), ('Catalog', 'ALL_PRIVILEGES', 'CREATE VOLUME'),
  ('Schema', 'ALL_PRIVILEGES', 'USE SCHEMA'), ('Schema', 'ALL_PRIVILEGES', 'SELECT'),
  ('Schema', 'ALL_PRIVILEGES', 'MODIFY'), ('Schema', 'ALL_PRIVILEGES', 'EXECUTE'),
  ('Schema', 'ALL_PRIVILEGES', 'READ VOLUME'), ('Schema', 'ALL_PRIVILEGES', 'WRITE VOLUME'),
  ('Schema', 'ALL_PRIVILEGES', 'CREATE TABLE'), ('Schema', 'ALL_PRIVILEGES', 'CREATE FUNCTION'),
  ('Schema', 'ALL_PRIVILEGES', 'CREATE VOLUME'), ('Table', 'ALL_PRIVILEGES', 'SELECT'),
  ('Table', 'ALL_PRIVILEGES', 'MODIFY'), ('Function', 'ALL_PRIVILEGES', 'EXECUTE'))
  AS v(type, privilegeType, privilegeInheritance)""",
}

BASE_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
    " p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,"
    " value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


class _References(dict):
    """Records which names a relation's text refers to."""

    def __init__(self) -> None:
        super().__init__()
        self.names: list[str] = []

    def __missing__(self, name: str) -> str:
        self.names.append(name)
        return name


def references(text: str) -> list[str]:
    seen = _References()
    text.format_map(seen)
    return list(dict.fromkeys(seen.names))


class Relations:
    """The relations of one data folder as Spark DataFrames, looked up by name."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in RELATIONS:
                text = RELATIONS[name]
                inputs = {ref: self[ref] for ref in references(text)}
                self._known[name] = self.spark.sql(text, **inputs)
            else:
                reader = self.spark.read.schema(BASE_TABLES[name])
                self._known[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._known[name]


def with_relations(query: str) -> str:
    """A DuckDB query preceded by the relations it refers to, each as a CTE."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for ref in references(text):
            if ref in RELATIONS and ref not in needed:
                visit(RELATIONS[ref])
                needed.append(ref)

    visit(query)
    every = {name: f"m_{name}" for name in RELATIONS} | {name: name for name in BASE_TABLES}
    ctes = [f"m_{name} AS ({RELATIONS[name].format_map(every)})" for name in needed]
    body = query.format_map(every).strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[len("WITH RECURSIVE ") :]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body

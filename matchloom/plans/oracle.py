"""The same results in plain SQL, written from the rules and not from the Spark plans."""

from __future__ import annotations

from matchloom.operators.outcome import (
    ARTIFACT_ITEMS,
    COMPONENT_ITEMS,
    EXOTECH_ITEMS,
    EXOTECH_RADIANT_ITEMS,
    RADIANT_ITEMS,
    SUPPORT_ITEMS,
    TYPE_ORDER,
)
from matchloom.plans.queries import FORECAST_BOARDS, FPGROWTH_SUPPORT, NEW_VERSION, OLD_VERSION, REPORT_LEVELS
from matchloom.sources.sample import BAD_DAYS, MARKER, MAX_LEVEL, SPECIAL_ITEMS, SUMMONS, TRAIT_NEEDS, UNITS_KNOWN


def r(x: str, digits: int) -> str:
    """Half-even rounding on the scaled value."""
    scale = f"{10**digits}.0::DOUBLE"
    return f"(round_even(({x}) * {scale}, 0) / {scale})"


def quoted(items: list[str]) -> str:
    return ", ".join(f"'{i}'" for i in items)


def text(items: str, sep: str = ",") -> str:
    return f"array_to_string({items}, '{sep}')"


SPECIAL = f"[{quoted(SPECIAL_ITEMS)}]"

CTE = {
    "matches": """
  matches AS (
    SELECT o_orderkey // 8 AS match_id, o_orderdate AS game_datetime,
           CAST(o_orderkey % 600 + 1200 AS DOUBLE) AS game_duration,
           '15.' || CAST((o_orderkey // 8) % 4 + 8 AS VARCHAR) AS game_version, 14 AS tft_set_number
    FROM orders WHERE o_orderkey % 8 = 0)""",
    "participants": """
  participants AS (
    SELECT o_orderkey // 8 AS match_id, o_orderkey AS puuid, CAST(o_orderkey % 8 + 1 AS INTEGER) AS placement,
           CAST(o_orderkey % 5 + 2 AS INTEGER) AS level
    FROM orders)""",
    "players": """
  players AS (
    SELECT m.game_version, p.match_id, p.puuid, p.placement, p.level
    FROM participants p JOIN matches m ON p.match_id = m.match_id)""",
    "units": f"""
  units AS (
    SELECT l_orderkey // 8 AS match_id, l_orderkey AS puuid,
           CASE WHEN l_quantity = 50 THEN 'T14_NoneUnit'
                ELSE 'T14_U' || CAST(l_partkey % 12 AS VARCHAR) END AS character_id,
           CAST(l_linenumber - 1 AS INTEGER) AS slot_idx,
           CAST(CASE WHEN l_quantity = 50 THEN -1 WHEN (l_partkey % 12) % 5 = 3 THEN 4
                     WHEN (l_partkey % 12) % 5 = 4 THEN 6 ELSE (l_partkey % 12) % 5 END AS INTEGER) AS rarity,
           CAST(CASE WHEN l_quantity = 50 THEN -1 ELSE CAST(l_quantity AS INTEGER) % 3 + 1 END AS INTEGER) AS tier,
           list_filter([
             CASE WHEN l_tax >= 0.04 THEN 'T_Item_' || l_returnflag || CAST(l_partkey % 4 AS VARCHAR) END,
             CASE WHEN l_discount >= 0.05 THEN ({SPECIAL})[CAST(l_partkey % 9 + 1 AS INTEGER)] END,
             CASE WHEN l_suppkey % 10 = 0 THEN 'T_Item_R' || CAST(l_suppkey % 6 AS VARCHAR) || 'EmblemItem' END,
             CASE WHEN l_quantity = 7 THEN 'T_Item_ThiefsGloves' END], lambda x: x IS NOT NULL) AS items
    FROM lineitem)""",
    "trait_needs": "\n  trait_needs AS (\n    SELECT * FROM (VALUES "
    + ", ".join(f"({i}, {n})" for i, n in enumerate(TRAIT_NEEDS))
    + ") AS t(r, needs))",
    "traits": """
  traits AS (
    SELECT match_id, puuid, trait_id, num_units,
           CAST(len(list_filter(needs, lambda n: n <= num_units)) AS INTEGER) AS current_tier,
           CAST(len(needs) AS INTEGER) AS max_tier,
           CAST(len(list_filter(needs, lambda n: n <= num_units)) AS INTEGER) AS trait_style
    FROM (SELECT o_orderkey // 8 AS match_id, o_orderkey AS puuid, 'T14_R' || CAST(r AS VARCHAR) AS trait_id,
                 CAST((o_orderkey // (2 * r + 3)) % 5 AS INTEGER) AS num_units, needs
          FROM orders, trait_needs)
    WHERE num_units > 0)""",
    "facts": """
  facts AS (
    SELECT p.game_version, p.placement, u.* FROM units u
    JOIN players p ON u.match_id = p.match_id AND u.puuid = p.puuid)""",
    "valid": """
  valid AS (SELECT * FROM facts WHERE rarity > -1)""",
    "totals": """
  totals AS (SELECT game_version, count(DISTINCT match_id) AS matches FROM valid GROUP BY game_version)""",
    "overall": f"""
  overall AS (
    SELECT game_version, character_id, rarity, count(placement) AS n, {r("avg(placement)", 2)} AS avg_place,
           {r("avg(CASE WHEN placement = 1 THEN 1.0 ELSE 0.0 END)", 3)} AS win,
           {r("avg(CASE WHEN placement <= 4 THEN 1.0 ELSE 0.0 END)", 3)} AS top4
    FROM valid GROUP BY ALL)""",
    "numbered": """
  numbered AS (
    SELECT match_id, puuid, character_id, rarity, tier, items,
           CAST(row_number() OVER (PARTITION BY match_id, puuid
             ORDER BY slot_idx, character_id, rarity, tier, items) - 1 AS INTEGER) AS slot_idx
    FROM units)""",
    "raw_people": """
  raw_people AS (
    SELECT o.*, 'M' || CAST(o_orderkey AS VARCHAR) AS match_id, CAST(i AS INTEGER) AS i,
           CAST(o_orderkey * 8 + i AS VARCHAR) AS puuid
    FROM orders o, range(0, 8) t(i))""",
    "raw_traits": """
  raw_traits AS (
    SELECT *, 'T14_R' || CAST((o_orderkey + i) % 6 AS VARCHAR) AS trait_id
    FROM raw_people WHERE (o_orderkey + i) % 4 <> 0)""",
    "raw_units": """
  raw_units AS (
    SELECT p.*, CAST(j AS INTEGER) AS j, 'T14_U' || CAST((o_orderkey * (j + 1) + 5 * i + 11 * j) % 12 AS VARCHAR) AS unit
    FROM raw_people p, range(0, 6) s(j) WHERE j < (o_orderkey + i) % 7)""",
}
NEEDS = {
    "players": ["matches", "participants"],
    "traits": ["trait_needs"],
    "facts": ["players", "units"],
    "valid": ["facts"],
    "totals": ["valid"],
    "overall": ["valid"],
    "numbered": ["units"],
    "raw_traits": ["raw_people"],
    "raw_units": ["raw_people"],
}


def with_(*names: str, then: str = "") -> str:
    """A WITH clause of the named parts, and of those they need, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH" + ",".join(CTE[n] for n in ordered) + (("," + then) if then else "") + "\n"


WIN = r("avg(CASE WHEN placement = 1 THEN 1.0 ELSE 0.0 END)", 3)
TOP4 = r("avg(CASE WHEN placement <= 4 THEN 1.0 ELSE 0.0 END)", 3)

SQL: dict[str, str] = {}

BASIC = f"""
  basic AS (
    SELECT o.game_version, character_id, rarity, {r("n / (matches * 8)", 3)} AS frequency, avg_place, win, top4
    FROM overall o JOIN totals t ON o.game_version = t.game_version)"""
SQL["basic_unit_stats"] = with_("overall", "totals", then=BASIC) + "SELECT * FROM basic"

# k-means itself is beyond SQL; what has to hold for its tiers isn't.
SQL["performance_tiers_hold"] = (
    with_("overall", "totals", then=BASIC)
    + """SELECT *, true AS nearest, true AS in_order FROM basic
WHERE game_version IS NOT NULL AND avg_place IS NOT NULL AND frequency IS NOT NULL AND win IS NOT NULL AND top4 IS NOT NULL"""
)

SQL["item_build_stats"] = (
    with_(
        "overall",
        then=f"""
  built AS (
    SELECT *, CASE WHEN len(items) = 0 THEN ''
        WHEN len(list_filter(items, lambda x: contains(x, 'ThiefsGloves'))) = 1
          THEN list_filter(items, lambda x: contains(x, 'ThiefsGloves'))[1]
        ELSE array_to_string(list_sort(items), '+') END AS item_build
    FROM valid),
  builds AS (
    SELECT game_version, character_id, rarity, item_build, count(placement) AS n, avg(placement) AS place,
           {WIN} AS win, {TOP4} AS top4
    FROM built WHERE item_build <> '' GROUP BY ALL HAVING count(placement) >= 10)""",
    )
    + f"""SELECT b.game_version, b.character_id, b.rarity, b.item_build, {r("b.n / o.n", 3)} AS frequency,
       {r("place", 2)} AS avg_place, {r("place - o.avg_place", 2)} AS avg_delta, b.win, b.top4
FROM builds b JOIN overall o
  ON b.game_version = o.game_version AND b.character_id = o.character_id AND b.rarity = o.rarity
WHERE {r("b.n / o.n", 3)} > 0"""
)

TRAIT_STATS = f"""
  active AS (
    SELECT p.game_version, p.placement, t.* FROM traits t
    JOIN players p ON t.match_id = p.match_id AND t.puuid = p.puuid
    WHERE current_tier > 0 AND max_tier > 0),
  active_totals AS (SELECT game_version, count(DISTINCT match_id) AS matches FROM active GROUP BY game_version),
  spans AS (
    SELECT DISTINCT game_version, trait_id, current_tier, max_tier,
           CAST(coalesce(n.needs[current_tier], 0) AS INTEGER) AS min_units_required
    FROM active a LEFT JOIN trait_needs n ON a.trait_id = 'T14_R' || CAST(n.r AS VARCHAR)),
  grouped AS (
    SELECT game_version, trait_id, current_tier, trait_style, count(*) AS n, {r("avg(placement)", 2)} AS avg_place,
           {WIN} AS win, {TOP4} AS top4
    FROM active GROUP BY ALL),
  stats AS (
    SELECT g.game_version, g.trait_id, g.current_tier, s.max_tier, g.trait_style, s.min_units_required,
           {r("n / matches", 2)} AS play_rate, avg_place, win, top4
    FROM grouped g JOIN active_totals t ON g.game_version = t.game_version
    LEFT JOIN spans s ON g.game_version = s.game_version AND g.trait_id = s.trait_id
      AND g.current_tier = s.current_tier)"""
SQL["trait_stats"] = with_("traits", "players", then=TRAIT_STATS) + "SELECT * FROM stats"

ITEM_TYPE = f"""CASE WHEN contains('TFT_Item_EmptyBag', items) THEN 'EmptyBag'
    WHEN items IN ({quoted(COMPONENT_ITEMS)}) THEN 'Component'
    WHEN items IN ({quoted(RADIANT_ITEMS)}) THEN 'Radiant'
    WHEN items IN ({quoted(ARTIFACT_ITEMS)}) THEN 'Artifact'
    WHEN items IN ({quoted(SUPPORT_ITEMS)}) THEN 'Support'
    WHEN items IN ({quoted(EXOTECH_ITEMS)}) THEN 'ExotechItem'
    WHEN items IN ({quoted(EXOTECH_RADIANT_ITEMS)}) THEN 'ExotechRadiantItem'
    WHEN contains(items, 'Emblem') THEN 'Emblem' ELSE 'Craftable' END"""
ITEMS = f"""
  held AS (SELECT * REPLACE (unnest(items) AS items) FROM facts WHERE len(items) > 0),
  held_totals AS (SELECT game_version, count(DISTINCT match_id) AS matches FROM held GROUP BY game_version),
  by_item AS (
    SELECT game_version, items, count(*) AS n, {r("avg(placement)", 2)} AS avg_place, {WIN} AS win, {TOP4} AS top4
    FROM held GROUP BY ALL),
  by_carrier AS (
    SELECT game_version, items, character_id, count(placement) AS n, avg(placement) AS place, {WIN} AS win, {TOP4} AS top4
    FROM held GROUP BY ALL),
  shares AS (
    SELECT c.game_version, c.items, c.character_id, c.n / i.n AS share, c.place, c.place - i.avg_place AS item_delta,
           c.place - o.avg_place AS unit_delta, c.win, c.top4, o.rarity
    FROM by_carrier c JOIN by_item i ON c.game_version = i.game_version AND c.items = i.items
    LEFT JOIN overall o ON c.game_version = o.game_version AND c.character_id = o.character_id
    WHERE c.n / i.n >= 0.01),
  carriers AS (
    SELECT * FROM (
      SELECT game_version, items, CAST(row_number() OVER (PARTITION BY game_version, items
               ORDER BY share DESC, character_id, rarity NULLS LAST) AS INTEGER) AS rank, character_id,
             {r("share", 3)} AS frequency, {r("place", 2)} AS avg_place, {r("item_delta", 2)} AS item_avg_delta,
             {r("unit_delta", 2)} AS unit_avg_delta, win, top4
      FROM shares) WHERE rank <= 10),
  typed AS (SELECT *, {ITEM_TYPE} AS type FROM by_item),
  item_stats AS (
    SELECT t.game_version, t.items, {r("n / (matches * 8)", 3)} AS frequency, {r("n / matches", 2)} AS play_rate,
           t.avg_place, t.win, t.top4, t.type,
           (SELECT string_agg(character_id, ',' ORDER BY rank) FROM carriers c
            WHERE c.game_version = t.game_version AND c.items = t.items) AS top_units
    FROM typed t JOIN held_totals h ON t.game_version = h.game_version
    WHERE t.type NOT IN ('Component', 'EmptyBag'))"""
SQL["item_top_carriers"] = with_("overall", then=ITEMS) + "SELECT * FROM carriers"
SQL["item_stats"] = with_("overall", then=ITEMS) + "SELECT * FROM item_stats"
SQL["item_scatter"] = (
    with_("overall", then=ITEMS)
    + f"SELECT items, avg_place, frequency FROM item_stats WHERE game_version = '{NEW_VERSION}' AND type = '{TYPE_ORDER[0]}'"
)

# Over loaded units: without summons, and placed by a left join with the participants that are there.
LOADED_FACTS = f"""
  facts AS (
    SELECT p.game_version, CASE WHEN p.puuid % 13 <> 0 THEN p.placement END AS placement, u.* FROM units u
    JOIN players p ON u.match_id = p.match_id AND u.puuid = p.puuid WHERE character_id NOT IN ({quoted(SUMMONS)}))"""


def loaded(sql: str) -> str:
    assert CTE["facts"] in sql
    return sql.replace(CTE["facts"], LOADED_FACTS)


for _name in ("item_build_stats", "item_stats"):
    SQL[f"loaded_{_name}"] = loaded(SQL[_name])
SQL["loaded_unit_stats"] = loaded(SQL["basic_unit_stats"])
SQL["loaded_trait_stats"] = SQL["trait_stats"].replace(
    "SELECT p.game_version, p.placement, t.* FROM traits t", "SELECT p.game_version, CASE WHEN p.puuid % 13 <> 0 THEN p.placement END AS placement, t.* FROM traits t"
)

SQL["load_matches_view"] = with_("matches") + "SELECT * FROM matches"
SQL["load_participants_view"] = with_("players") + "SELECT * FROM players"
SQL["load_units_view"] = (
    with_("players", "units")
    + f"""SELECT game_version, u.match_id, u.puuid, character_id,
       CAST(row_number() OVER (PARTITION BY u.match_id, u.puuid
         ORDER BY slot_idx, character_id, rarity, tier, items) - 1 AS INTEGER) AS slot_idx,
       rarity, tier, {text("items")} AS items
FROM units u JOIN players p ON u.match_id = p.match_id AND u.puuid = p.puuid
WHERE character_id NOT IN ({quoted(SUMMONS)})"""
)
BY_TEXT = "SELECT * REPLACE (CAST(match_id AS VARCHAR) AS match_id, CAST(puuid AS VARCHAR) AS puuid) FROM"
SQL["stored_units_view"] = f"{BY_TEXT} ({SQL['load_units_view']})"
SQL["load_traits_view"] = (
    with_("players", "traits")
    + """SELECT game_version, t.* FROM traits t JOIN players p ON t.match_id = p.match_id AND t.puuid = p.puuid"""
)

SQL["board_cleanup"] = (
    with_(
        "numbered",
        then=f"""
  last_marker AS (
    SELECT match_id, puuid, max(slot_idx) AS last, count(*) AS markers, arg_max(len(items), slot_idx) AS n_items
    FROM numbered WHERE character_id = '{MARKER}' GROUP BY ALL),
  following AS (
    SELECT n.match_id, n.puuid, min(slot_idx) AS slot FROM numbered n
    JOIN last_marker l ON n.match_id = l.match_id AND n.puuid = l.puuid
    WHERE slot_idx > last AND character_id NOT IN ({quoted(SUMMONS)}) GROUP BY ALL),
  gone AS (
    SELECT l.match_id, l.puuid, coalesce(f.slot, CASE WHEN markers >= 2 AND n_items = 1 THEN last END) AS slot
    FROM last_marker l LEFT JOIN following f ON l.match_id = f.match_id AND l.puuid = f.puuid),
  kept AS (
    SELECT n.* FROM numbered n LEFT JOIN gone g ON n.match_id = g.match_id AND n.puuid = g.puuid
    WHERE g.slot IS NULL OR g.slot <> n.slot_idx)""",
    )
    + f"""SELECT match_id, puuid, character_id, rarity, tier, {text("items")} AS items,
       CAST(row_number() OVER (PARTITION BY match_id, puuid ORDER BY slot_idx) - 1 AS INTEGER) AS slot_idx
FROM kept"""
)

SQL["parse_and_explode"] = """
SELECT l_orderkey AS match_id, l_partkey AS puuid, 'TFT_NoneUnit' AS character_id, 0 AS slot_idx, -1 AS rarity,
       -1 AS tier, '' AS items, l_linenumber, l_suppkey FROM lineitem WHERE l_linenumber = 1
UNION ALL
SELECT l_orderkey, l_partkey, 'T14_U' || CAST(l_partkey % 12 AS VARCHAR), 0, CAST(l_partkey % 5 AS INTEGER),
       CASE WHEN l_linenumber % 3 <> 0 THEN 2 END,
       'x: None, ' || l_returnflag || '|o''' || l_linestatus, l_linenumber, l_suppkey
FROM lineitem WHERE l_linenumber > 1
UNION ALL
SELECT l_orderkey, l_partkey, 'T14_U' || CAST(l_suppkey % 12 AS VARCHAR), 1, CAST(l_suppkey % 5 AS INTEGER),
       CAST(l_linenumber % 3 + 1 AS INTEGER), '', l_linenumber, l_suppkey
FROM lineitem WHERE l_linenumber > 2"""
SQL["parse_failures"] = """
SELECT l_linenumber, count(*) AS n_rows, count(CASE WHEN l_partkey % 7 = 0 THEN 1 END) AS n_failed
FROM lineitem GROUP BY l_linenumber"""
SQL["epoch_and_version_extract"] = """
SELECT 'M' || CAST(o_orderkey AS VARCHAR) AS match_id, o_orderdate AS game_datetime,
       CAST(1500 + o_orderkey % 300 AS DOUBLE) AS game_duration,
       CASE WHEN o_orderkey % 11 <> 0 THEN '15.' || CAST(8 + o_orderkey % 4 AS VARCHAR) END AS game_version,
       14 AS tft_set_number
FROM orders"""

SQL["seed_topup"] = """
WITH full_tiers AS (SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
  third AS (
    SELECT *, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS place
    FROM customer WHERE c_mktsegment = 'FURNITURE')
SELECT c_custkey, c_mktsegment, c_acctbal FROM full_tiers
UNION ALL
SELECT c_custkey, c_mktsegment, c_acctbal FROM third WHERE place <= 1000 - (SELECT count(*) FROM full_tiers)"""
SQL["day_window"] = """
SELECT event_id, ts, user_id FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'"""
SQL["per_key_cap"] = """
SELECT event_id, user_id, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events) WHERE n <= 50"""
SQL["dedup_ids"] = """
SELECT o_orderkey // 8 AS match_id FROM orders UNION SELECT l_orderkey // 8 FROM lineitem"""
HEADER = """'M' || CAST(o_orderkey AS VARCHAR) AS match_id, epoch_ms(o_orderdate) AS game_datetime"""
RAW_VERSION = """CASE WHEN o_orderkey % 11 = 0 THEN 'unknown'
         ELSE 'Linux Version 15.' || CAST(8 + o_orderkey % 4 AS VARCHAR) || '.672.4034 (x)' END AS game_version"""
SQL["queue_filter"] = f"SELECT {HEADER}, {RAW_VERSION} FROM orders WHERE o_orderkey % 3 <> 0"
SQL["flatten_match"] = f"""
SELECT {HEADER}, CAST(1500 + o_orderkey % 300 AS DOUBLE) AS game_length, {RAW_VERSION}, 14 AS tft_set_number
FROM orders"""
SQL["flatten_participants"] = (
    with_("raw_people", "raw_units")
    + """SELECT p.match_id, p.puuid, 'player' || CAST(p.o_custkey AS VARCHAR) AS name, p.o_orderstatus AS tagline,
       p.i + 1 AS placement, CAST(2 + (p.o_orderkey + p.i) % 5 AS INTEGER) AS level,
       CASE WHEN (p.o_orderkey + p.i) % 4 = 0 THEN '' ELSE 'T14_R' || CAST((p.o_orderkey + p.i) % 6 AS VARCHAR) END AS traits,
       coalesce(u.listed, '') AS units, CAST(p.o_orderkey % 150 AS INTEGER) AS total_damages,
       p.i % 3 AS player_eliminated, CAST(1000 + p.i AS DOUBLE) AS time_eliminated, 30 + p.i AS last_round,
       CAST(p.o_custkey % 50 AS INTEGER) AS gold_left, 'C' || CAST(p.o_custkey % 9 AS VARCHAR) AS companion
FROM raw_people p
LEFT JOIN (SELECT puuid, string_agg(unit, ',' ORDER BY j) AS listed FROM raw_units GROUP BY puuid) u ON p.puuid = u.puuid
WHERE p.o_orderkey % 3 <> 0"""
)
SQL["explode_traits"] = (
    with_("raw_people", "raw_traits")
    + """SELECT match_id, puuid, trait_id, CAST(1 + (o_orderkey + i) % 4 AS INTEGER) AS num_units,
       CAST((o_orderkey + i) % 3 AS INTEGER) AS current_tier, 2 AS max_tier, 1 AS trait_style FROM raw_traits
UNION ALL
SELECT match_id, puuid, 'TFT_NoneTrait', -1, -1, -1, -1 FROM raw_people WHERE (o_orderkey + i) % 4 = 0"""
)
SQL["explode_units"] = (
    with_("raw_people", "raw_units")
    + """SELECT match_id, puuid, unit AS character_id, j AS slot_idx, j % 5 AS rarity, 1 + j % 3 AS tier,
       CASE WHEN (o_orderkey + j) % 2 = 0 THEN 'T_Item_' || o_orderstatus ELSE '' END AS items FROM raw_units
UNION ALL
SELECT match_id, puuid, 'TFT_NoneUnit', 0, -1, -1, '' FROM raw_people WHERE (o_orderkey + i) % 7 = 0"""
)

SQL["board_cleanup_lists"] = (
    with_(
        "raw_people",
        "raw_units",
        then=f"""
  last_marker AS (
    SELECT puuid, max(j) AS last, count(*) AS markers, arg_max(CAST((o_orderkey + j) % 2 = 0 AS INTEGER), j) AS n_items
    FROM raw_units WHERE unit = '{MARKER}' GROUP BY ALL),
  following AS (
    SELECT u.puuid, min(j) AS slot FROM raw_units u JOIN last_marker l ON u.puuid = l.puuid
    WHERE j > last AND unit NOT IN ({quoted(SUMMONS)}) GROUP BY ALL),
  gone AS (
    SELECT l.puuid, coalesce(f.slot, CASE WHEN markers >= 2 AND n_items = 1 THEN last END) AS slot
    FROM last_marker l LEFT JOIN following f ON l.puuid = f.puuid)""",
    )
    + """SELECT match_id, u.puuid, unit AS character_id,
       CAST(row_number() OVER (PARTITION BY u.puuid ORDER BY j) - 1 AS INTEGER) AS slot_idx,
       j % 5 AS rarity, 1 + j % 3 AS tier, CASE WHEN (o_orderkey + j) % 2 = 0 THEN 'T_Item_' || o_orderstatus ELSE '' END AS items
FROM raw_units u LEFT JOIN gone g ON u.puuid = g.puuid WHERE g.slot IS NULL OR g.slot <> j
UNION ALL
SELECT match_id, puuid, 'TFT_NoneUnit', 0, -1, -1, '' FROM raw_people WHERE (o_orderkey + i) % 7 = 0"""
)

SQL["pk_violations"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1"""
SQL["orphan_rows"] = """
SELECT 'line without order' AS check_name, l_orderkey AS key, count(*) AS n_rows FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY ALL
UNION ALL
SELECT 'order without line', o_orderkey, count(*) FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL
UNION ALL
SELECT 'order without customer', o_custkey, count(*) FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY ALL
UNION ALL
SELECT 'customer without order', c_custkey, count(*) FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) GROUP BY ALL"""
SQL["group_size_check"] = """
SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n_rows FROM events GROUP BY ALL HAVING count(*) <> 8"""
SQL["cast_failures"] = """
SELECT 'user_text' AS column_name, 'int' AS wanted_type, count(*) AS present,
       count(CASE WHEN event_id % 9 = 0 THEN 1 END) AS failed FROM events
UNION ALL
SELECT 'value_text', 'double', count(CASE WHEN event_id % 4 <> 0 THEN value END), 0 FROM events
UNION ALL
SELECT 'event_type', 'int', count(event_type), count(event_type) FROM events"""
SQL["unknown_ids"] = (
    with_("units")
    + f"""SELECT character_id, count(*) AS n_rows FROM units
WHERE character_id NOT IN ({quoted([f"T14_U{u}" for u in range(UNITS_KNOWN)])}) GROUP BY ALL"""
)

MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"
SQL["pending_dates"] = f"SELECT DISTINCT {MONTH} AS run_date FROM orders WHERE month(o_orderdate) % 2 = 1"
SQL["ledger_upsert"] = f"""
SELECT DISTINCT {MONTH} AS loaded_date, CASE WHEN month(o_orderdate) % 2 = 0 THEN TIMESTAMP '2024-01-01 00:00:00'
       ELSE TIMESTAMP '2024-02-01 00:00:00' END AS last_loaded FROM orders"""
SQL["audit_counts"] = f"""
SELECT 'participants' AS table_name, {MONTH} AS run_date, count(*) AS n_rows FROM orders GROUP BY ALL
UNION ALL
SELECT 'units', CAST(date_trunc('month', l_shipdate) AS DATE), count(*) FROM lineitem GROUP BY ALL"""
YEAR = "CAST(date_trunc('year', o_orderdate) AS DATE)"
TABLES_BY_YEAR = f"""
WITH days AS (SELECT {YEAR} AS run_date, o_orderkey FROM orders WHERE o_orderkey % 3 <> 0)
SELECT 'matches' AS table_name, run_date, count(*) AS n_rows FROM days GROUP BY ALL
UNION ALL
SELECT 'participants', run_date, 8 * count(*) FROM days GROUP BY ALL
UNION ALL
SELECT 'traits', run_date, 8 * count(*) FROM days GROUP BY ALL
UNION ALL
SELECT 'units', run_date, count(*) FROM (
  SELECT run_date, unnest(range(0, CAST(greatest(1, (o_orderkey + i) % 7) AS BIGINT))) FROM days, range(0, 8) t(i))
GROUP BY ALL
UNION ALL
SELECT DISTINCT 'loaded_dates', run_date, 1 FROM days"""
SQL["stream_load_tables"] = TABLES_BY_YEAR
SQL["load_landed_days"] = TABLES_BY_YEAR + "".join(
    f"\nUNION ALL\nSELECT 'rejected_dates', DATE '{day}', 1" for day in BAD_DAYS
)

BRAND_IDS = """
  brand_ids AS (
    SELECT DISTINCT p_brand AS trait_name, 'T14_' || p_brand AS trait_id FROM part
    WHERE CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) % 2 = 0)"""
SQL["dim_trait_tiers"] = (
    with_(
        "traits",
        then="""
  last_part AS (SELECT p_partkey % 7 AS r, arg_max(p_size, p_partkey) AS p_size, max(p_partkey) AS k FROM part GROUP BY ALL),
  names AS (SELECT 'T14_R' || CAST(s_suppkey % 5 AS VARCHAR) AS trait_id, arg_max(s_name, s_suppkey) AS name FROM supplier GROUP BY ALL),
  tiers AS (
    SELECT 'T14_R' || CAST(r AS VARCHAR) AS trait_id, CAST(i AS INTEGER) AS tier,
           CAST(i * (1 + p_size % 4) AS INTEGER) AS min_units
    FROM last_part, range(1, 4) t(i) WHERE i <= 1 + k % 3)""",
    )
    + """SELECT t.trait_id, n.name, t.tier, t.min_units FROM tiers t LEFT JOIN names n ON t.trait_id = n.trait_id
WHERE t.trait_id IN (SELECT trait_id FROM traits)"""
)
SQL["dim_unit_traits"] = (
    with_(
        "units",
        then=BRAND_IDS
        + """,
  last_part AS (
    SELECT 'T14_U' || CAST(p_partkey % 14 AS VARCHAR) AS character_id, arg_max(p_brand, p_partkey) AS p_brand
    FROM part GROUP BY ALL),
  names AS (SELECT 'T14_U' || CAST(p_partkey % 10 AS VARCHAR) AS character_id, arg_max(p_name, p_partkey) AS name FROM part GROUP BY ALL)""",
    )
    + """SELECT l.character_id, n.name, coalesce(b.trait_id, 'null') || ',null' AS traits
FROM last_part l LEFT JOIN names n ON l.character_id = n.character_id
LEFT JOIN brand_ids b ON l.p_brand = b.trait_name
WHERE l.character_id IN (SELECT character_id FROM units)"""
)
SQL["dim_emblems"] = (
    "WITH"
    + BRAND_IDS
    + """
SELECT 'T_Item_P' || CAST(p_partkey AS VARCHAR) || 'EmblemItem' AS item_id,
       CASE WHEN p_partkey % 2 = 0 THEN b.trait_id END AS trait_id
FROM part p LEFT JOIN brand_ids b ON p.p_brand = b.trait_name WHERE p_partkey % 3 = 0"""
)
for _name in ("dim_unit_traits", "dim_emblems"):
    assert BRAND_IDS in SQL[_name]
    SQL[f"{_name}_of_facts"] = SQL[_name].replace(BRAND_IDS, BRAND_IDS.replace("% 2 = 0", "% 4 = 0"))
SQL["dim_version"] = (
    with_("matches")
    + """SELECT game_version || '.1' AS reference_version FROM matches
ORDER BY CAST(split_part(game_version, '.', 1) AS INTEGER), CAST(split_part(game_version, '.', 2) AS INTEGER) LIMIT 1"""
)

# Compositions. Unit ids sort by rarity, then name; trait ids by count and tier downwards, then name.
COMPS = f"""
  unit_lists AS (
    SELECT match_id, puuid, count(*) AS n,
           list(character_id || '_' || rarity ORDER BY rarity, split_part(character_id, '_', 2)) AS combine_units,
           list(character_id || '_' || rarity || '_' || tier
                ORDER BY rarity, split_part(character_id, '_', 2), tier) AS combine_full_units
    FROM units WHERE rarity > -1 AND character_id NOT IN ({quoted(SUMMONS)}) GROUP BY ALL),
  held AS (
    SELECT match_id, puuid, slot_idx, character_id || '_' || rarity AS unit, character_id || '_' || rarity || '_' || tier AS fu,
           list_filter(items, lambda x: contains(x, 'Emblem')) AS emblem_items
    FROM units WHERE rarity > -1 AND character_id NOT IN ({quoted(SUMMONS)})),
  emblem_lists AS (
    SELECT match_id, puuid,
           flatten(list(list_transform(emblem_items, lambda x: replace(replace(x, 'T_Item_', 'T14_'), 'EmblemItem', ''))
                        ORDER BY slot_idx, unit, fu, emblem_items)) AS emblems
    FROM held GROUP BY ALL),
  trait_lists AS (
    SELECT match_id, puuid,
           list(trait_id || '_' || num_units || '_' || current_tier
                ORDER BY num_units DESC, current_tier DESC, split_part(trait_id, '_', 2)) AS combine_full_traits,
           list(trait_id || '_' || num_units || '_' || current_tier
                ORDER BY num_units DESC, current_tier DESC, split_part(trait_id, '_', 2))
             FILTER (WHERE current_tier > 0) AS combine_active_traits,
           count(*) FILTER (WHERE current_tier > 0 AND num_units >= 2 AND NOT list_contains(needs, num_units)) AS n_illegal
    FROM traits t JOIN trait_needs x ON t.trait_id = 'T14_R' || CAST(x.r AS VARCHAR) GROUP BY ALL),
  comps AS (
    SELECT p.game_version, p.match_id, p.puuid, p.placement, p.level, combine_units, combine_full_units,
           combine_active_traits, combine_full_traits, len(emblems) > 0 AS has_emblem, emblems
    FROM unit_lists u JOIN players p ON u.match_id = p.match_id AND u.puuid = p.puuid AND u.n = p.level
    JOIN trait_lists t ON u.match_id = t.match_id AND u.puuid = t.puuid
    JOIN emblem_lists e ON u.match_id = e.match_id AND u.puuid = e.puuid
    WHERE combine_active_traits IS NOT NULL AND n_illegal <= 1)"""
UNIT_TRAITS = (
    "\n  unit_traits AS (\n    SELECT * FROM (VALUES "
    + ", ".join(
        f"('T14_U{u}', [{quoted([f'T14_R{u % 4}'] + ([f'T14_R{4 + u % 2}'] if u % 3 == 0 else []))}])"
        for u in range(UNITS_KNOWN)
    )
    + ") AS t(character_id, traits))"
)


def comps_with(*then: str) -> str:
    return with_("players", "units", "traits", then=",".join([COMPS, *then]))


SQL["comps"] = (
    comps_with()
    + f"""SELECT game_version, match_id, puuid, placement, level, {text("combine_units")} AS combine_units,
       {text("combine_full_units")} AS combine_full_units, {text("combine_active_traits")} AS combine_active_traits,
       {text("combine_full_traits")} AS combine_full_traits, has_emblem, {text("emblems")} AS emblems FROM comps"""
)
SQL["stored_comps"] = f"{BY_TEXT} ({SQL['comps']})"
SQL["legal_comps_by_units"] = (
    comps_with(
        UNIT_TRAITS,
        """
  one AS (SELECT match_id, puuid, unnest(combine_units) AS unit FROM comps),
  named AS (
    SELECT match_id, puuid, unnest(traits) AS trait_id FROM one
    JOIN unit_traits ON character_id = split_part(unit, '_', 1) || '_' || split_part(unit, '_', 2)),
  counted AS (SELECT match_id, puuid, trait_id, count(*) AS n FROM named GROUP BY ALL),
  off AS (
    SELECT match_id, puuid, count(*) AS n_off FROM counted c JOIN trait_needs x
      ON c.trait_id = 'T14_R' || CAST(x.r AS VARCHAR)
    WHERE n >= 2 AND NOT list_contains(needs, CAST(n AS INTEGER)) GROUP BY ALL)""",
    )
    + f"""SELECT c.match_id, c.puuid, {text("combine_units")} AS combine_units, coalesce(n_off, 0) = 0 AS is_legal
FROM comps c LEFT JOIN off o ON c.match_id = o.match_id AND c.puuid = o.puuid"""
)
SQL["legal_comps_by_traits"] = (
    comps_with(
        """
  off AS (
    SELECT match_id, puuid, count(*) AS n_off FROM traits t JOIN trait_needs x
      ON t.trait_id = 'T14_R' || CAST(x.r AS VARCHAR)
    WHERE num_units >= 2 AND NOT list_contains(needs, num_units) GROUP BY ALL)"""
    )
    + f"""SELECT c.match_id, c.puuid, {text("combine_full_traits")} AS combine_full_traits, coalesce(n_off, 0) = 0 AS is_legal
FROM comps c LEFT JOIN off o ON c.match_id = o.match_id AND c.puuid = o.puuid"""
)
SQL["active_traits"] = (
    comps_with(
        UNIT_TRAITS,
        """
  one AS (SELECT match_id, puuid, unnest(combine_units) AS unit FROM comps),
  named AS (
    SELECT match_id, puuid, unnest(traits) AS trait_id FROM one
    JOIN unit_traits ON character_id = split_part(unit, '_', 1) || '_' || split_part(unit, '_', 2)
    UNION ALL SELECT match_id, puuid, unnest(emblems) FROM comps),
  counted AS (SELECT match_id, puuid, trait_id, count(*) AS n FROM named GROUP BY ALL),
  reached AS (
    SELECT match_id, puuid, string_agg(trait_id || ':' || n, ',' ORDER BY n DESC, trait_id) AS listed
    FROM counted c JOIN trait_needs x ON c.trait_id = 'T14_R' || CAST(x.r AS VARCHAR)
    WHERE n >= needs[1] GROUP BY ALL)""",
    )
    + """SELECT c.match_id, c.puuid, coalesce(listed, '') AS active_traits
FROM comps c LEFT JOIN reached r ON c.match_id = r.match_id AND c.puuid = r.puuid"""
)
SQL["unit_list_projections"] = (
    comps_with(
        """
  one AS (SELECT match_id, puuid, unnest(combine_full_units) AS f FROM comps),
  parts AS (
    SELECT *, split_part(f, '_', 2) AS name, CAST(split_part(f, '_', 3) AS INTEGER) AS rarity,
           CAST(split_part(f, '_', 4) AS INTEGER) AS tier,
           split_part(f, '_', 1) || '_' || split_part(f, '_', 2) AS id FROM one)"""
    )
    + """SELECT match_id, puuid, string_agg(CAST(tier AS VARCHAR), ',' ORDER BY rarity, name, tier) AS tiers,
       string_agg(id || '_' || rarity, ',' ORDER BY rarity, name, tier) AS bases,
       string_agg(id || '_' || rarity || '_' || greatest(tier, 2), ',' ORDER BY rarity, name, greatest(tier, 2)) AS raised,
       string_agg(id, ',' ORDER BY rarity, name, tier) AS ids
FROM parts GROUP BY match_id, puuid"""
)


def frequent(top: int) -> str:
    """Whole boards without repeated units, the most common of each version and level."""
    return f"""
  boards AS (
    SELECT game_version, level, list_sort(list_distinct(combine_units)) AS itemset, count(*) AS n
    FROM comps GROUP BY ALL),
  board_totals AS (SELECT game_version, level, CAST(sum(n) AS BIGINT) AS total FROM boards GROUP BY ALL),
  whole AS (
    SELECT b.*, total, list_sort(list_transform(itemset, lambda x: (CAST(split_part(x, '_', 3) AS INTEGER),
             split_part(x, '_', 2), x))) AS keyed
    FROM boards b JOIN board_totals t ON b.game_version = t.game_version AND b.level = t.level
    WHERE len(itemset) = b.level AND n >= ceil(total * 0.001)),
  listed AS (
    SELECT *, list_transform(itemset, lambda x: x) AS plain,
           (SELECT list(x ORDER BY CAST(split_part(x, '_', 3) AS INTEGER), split_part(x, '_', 2))
            FROM unnest(itemset) q(x)) AS itemsets
    FROM whole),
  frequent AS (
    SELECT game_version, level, itemsets, itemset, {r("n / total", 4)} AS support FROM (
      SELECT *, row_number() OVER (PARTITION BY game_version, level ORDER BY n DESC, itemsets) AS place FROM listed)
    WHERE place <= {top})"""


SQL["frequent_comps"] = (
    comps_with(frequent(10)) + f"SELECT game_version, level, {text('itemsets')} AS itemsets, support FROM frequent"
)

SQL["frequent_comps_mined"] = SQL["frequent_comps"]

SQL["itemsets_fpgrowth"] = (
    comps_with(
        f"""
  baskets AS (
    SELECT game_version, match_id, puuid, CAST(sum(DISTINCT 1 << CAST(replace(split_part(unit, '_', 2), 'U', '') AS INTEGER))
             AS BIGINT) AS mask
    FROM (SELECT game_version, match_id, puuid, unnest(combine_units) AS unit FROM comps) GROUP BY ALL),
  masks AS (SELECT game_version, mask, count(*) AS n FROM baskets GROUP BY ALL),
  basket_totals AS (SELECT game_version, CAST(sum(n) AS BIGINT) AS total FROM masks GROUP BY ALL),
  parts AS (SELECT m AS part FROM range(1, {2**UNITS_KNOWN}) t(m)),
  counted AS (
    SELECT game_version, part, CAST(sum(n) AS BIGINT) AS freq FROM masks JOIN parts ON (mask & part) = part GROUP BY ALL)"""
    )
    + f"""SELECT c.game_version, array_to_string(list_sort(list_transform(
         list_filter(range(0, {UNITS_KNOWN}), lambda u: (part & (1 << CAST(u AS INTEGER))) > 0),
         lambda u: 'T14_U' || CAST(u AS VARCHAR) || '_' ||
           CAST(CASE WHEN u % 5 = 3 THEN 4 WHEN u % 5 = 4 THEN 6 ELSE u % 5 END AS VARCHAR))), ',') AS itemsets,
       freq, {r("freq / total", 4)} AS support
FROM counted c JOIN basket_totals b ON c.game_version = b.game_version WHERE freq >= ceil(total * {FPGROWTH_SUPPORT})"""
)

DEDUP = """
  placed AS (
    SELECT *, row_number() OVER (PARTITION BY game_version ORDER BY level, support DESC, itemsets) AS pos FROM frequent),
  distinct_comps AS (
    SELECT * FROM placed c WHERE NOT EXISTS (
      SELECT 1 FROM placed e
      WHERE e.game_version = c.game_version AND e.pos < c.pos AND list_has_all(c.itemset, e.itemset)))"""
SQL["dedup_comps"] = (
    comps_with(frequent(100), DEDUP)
    + f"SELECT game_version, {text('itemsets')} AS itemsets, level FROM distinct_comps"
)

RAISE = """(SELECT list(id || '_' || rarity || '_' || greatest(tier, 2) ORDER BY rarity, name, greatest(tier, 2)) FROM (
           SELECT split_part(f, '_', 1) || '_' || split_part(f, '_', 2) AS id, split_part(f, '_', 2) AS name,
                  CAST(split_part(f, '_', 3) AS INTEGER) AS rarity, CAST(split_part(f, '_', 4) AS INTEGER) AS tier
           FROM unnest(combine_full_units) q(f)))"""


def evolution(within_version: bool) -> str:
    """One step per level: the most common candidate that holds the board taken before."""
    same = "AND b.game_version = d.game_version" if within_version else ""
    by = "game_version, " if within_version else ""
    steps = [
        f"""
  full_boards AS (
    SELECT {by}level, combine_full_units, combine_units, count(*) AS n FROM comps GROUP BY ALL),
  candidates AS (
    SELECT d.game_version, d.level AS start_level, d.itemsets, b.level, b.n, b.combine_full_units,
           {RAISE} AS board, b.combine_units AS base
    FROM distinct_comps d JOIN full_boards b ON b.level >= d.level {same}
      AND list_has_all(b.combine_units, d.itemset)),
  step_1 AS (
    SELECT game_version, level AS start_level, itemsets, CAST(NULL AS VARCHAR[]) AS taken FROM distinct_comps)"""
    ]
    for level in range(2, MAX_LEVEL + 1):
        done = "".join(f", s.level_{n}" for n in range(2, level))
        steps.append(
            f"""
  found_{level} AS (
    SELECT s.game_version, s.start_level, s.itemsets, c.board, c.base,
           row_number() OVER (PARTITION BY s.game_version, s.start_level, s.itemsets
                              ORDER BY c.n DESC, c.combine_full_units) AS place
    FROM step_{level - 1} s JOIN candidates c ON c.game_version = s.game_version AND c.start_level = s.start_level
      AND c.itemsets = s.itemsets AND c.level = {level} AND (s.taken IS NULL OR list_has_all(c.base, s.taken))),
  step_{level} AS (
    SELECT s.game_version, s.start_level, s.itemsets, coalesce(f.base, s.taken) AS taken{done}, f.board AS level_{level}
    FROM step_{level - 1} s LEFT JOIN found_{level} f ON f.game_version = s.game_version
      AND f.start_level = s.start_level AND f.itemsets = s.itemsets AND f.place = 1)"""
        )
    return ",".join(steps)


GROWN_COLUMNS = ", ".join(f"array_to_string(level_{n}, ',') AS level_{n}" for n in range(2, MAX_LEVEL + 1))
for _name, _within in (("comp_evolution", False), ("comp_evolution_by_version", True)):
    SQL[_name] = (
        comps_with(frequent(100), DEDUP, evolution(_within))
        + f"""SELECT game_version, start_level AS level, {text("itemsets")} AS itemsets, {GROWN_COLUMNS}
FROM step_{MAX_LEVEL}"""
    )


def _board_traits(level: int) -> str:
    return f"""CASE WHEN level_{level} IS NOT NULL THEN coalesce((
         SELECT string_agg(trait_id || ':' || n, ',' ORDER BY n DESC, trait_id) FROM (
           SELECT trait_id, count(*) AS n FROM (
             SELECT unnest(t.traits) AS trait_id FROM unnest(level_{level}) q(f) JOIN unit_traits t
               ON t.character_id = split_part(f, '_', 1) || '_' || split_part(f, '_', 2)) GROUP BY trait_id) c
         JOIN trait_needs x ON c.trait_id = 'T14_R' || CAST(x.r AS VARCHAR) WHERE c.n >= x.needs[1]), '') END"""


SQL["comp_stats"] = (
    comps_with(
        frequent(100),
        DEDUP,
        evolution(False),
        UNIT_TRAITS,
        f"""
  comp_totals AS (SELECT game_version, count(DISTINCT match_id) AS matches FROM comps GROUP BY ALL),
  outcomes AS (
    SELECT d.game_version, d.level, d.itemsets, count(*) AS n, {r("avg(placement)", 2)} AS avg_place,
           {WIN} AS win, {TOP4} AS top4
    FROM distinct_comps d JOIN comps c ON c.game_version = d.game_version AND list_has_all(c.combine_units, d.itemset)
    GROUP BY ALL)""",
    )
    + f"""SELECT o.game_version, o.level, {text("o.itemsets")} AS itemsets,
       {", ".join(f"array_to_string(level_{n}, ',') AS level_{n}, {_board_traits(n)} AS level_{n}_traits" for n in REPORT_LEVELS)},
       {r("o.n / matches", 2)} AS play_rate, avg_place, win, top4
FROM outcomes o JOIN comp_totals t ON o.game_version = t.game_version
JOIN step_{MAX_LEVEL} s ON s.game_version = o.game_version AND s.start_level = o.level AND s.itemsets = o.itemsets"""
)

_MEASURES = ["frequency", "avg_place", "win", "top4"]
_OLD = ", ".join(f"max({m}) FILTER (WHERE game_version = '{OLD_VERSION}') AS {m}_old" for m in _MEASURES)
_NEW = ", ".join(f"max({m}) FILTER (WHERE game_version = '{NEW_VERSION}') AS {m}_new" for m in _MEASURES)
SQL["version_delta"] = (
    with_(
        "overall",
        "totals",
        then=f"""{BASIC},
  wide AS (
    SELECT character_id, rarity, {_OLD}, {_NEW} FROM basic
    WHERE game_version IN ('{OLD_VERSION}', '{NEW_VERSION}') GROUP BY ALL)""",
    )
    + f"SELECT *, {', '.join(r(f'{m}_new - {m}_old', 3) + f' AS {m}_change' for m in _MEASURES)} FROM wide"
)
SQL["top_traits_by_style"] = (
    with_("traits", "players", then=TRAIT_STATS)
    + """SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY game_version, trait_style
    ORDER BY play_rate DESC, trait_id, current_tier, max_tier) AS INTEGER) AS rank FROM stats) WHERE rank <= 5"""
)
SQL["flags"] = (
    with_("traits", "players", then=TRAIT_STATS)
    + "SELECT *, play_rate > 1 AS overpowered, avg_place < 4.5 AS better FROM stats"
)

SQL["stream_daily_stats"] = f"""
WITH placed AS (SELECT CAST(ts AS DATE) AS day, event_type, CAST(user_id % 8 + 1 AS INTEGER) AS placement FROM events)
SELECT day, event_type, count(placement) AS frequency, {r("avg(placement)", 2)} AS avg_place, {WIN} AS win, {TOP4} AS top4
FROM placed GROUP BY ALL"""
SQL["stream_load_dedup"] = """
SELECT DISTINCT event_type || '-' || CAST(event_id % 997 AS VARCHAR) AS match_id FROM events"""


SQL["landed_drift"] = """
WITH years AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS run_year, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS n FROM orders GROUP BY ALL)
SELECT run_year, 'info.game_length' AS path, 'retyped' AS problem, 'string' AS found, 'double' AS expected, NULL::BIGINT AS n_rows
FROM years WHERE run_year % 4 = 1
UNION ALL SELECT run_year, 'info.tft_set_number', 'missing', NULL, 'int', NULL FROM years WHERE run_year % 4 = 2
UNION ALL SELECT run_year, 'info.extras[].kind', 'added', 'bigint', NULL, NULL FROM years WHERE run_year % 4 = 3
UNION ALL SELECT run_year, '', 'does not parse', NULL, NULL, n FROM years WHERE run_year % 4 = 0 AND n > 0"""

SQL["stream_dedup_state"] = SQL["stream_load_dedup"]
SQL["stream_daily_rates"] = f"""
WITH e AS (SELECT CAST(ts AS DATE) AS day, event_type, event_id // 8 AS match_no, user_id % 8 + 1 AS placement FROM events),
  m AS (SELECT day, count(DISTINCT match_no) AS matches FROM e GROUP BY ALL)
SELECT e.day, event_type, any_value(matches) AS matches, {r("count(*) / (any_value(matches) * 8)", 3)} AS frequency,
  {r("count(*) / any_value(matches)", 2)} AS play_rate, {r("avg(placement)", 2)} AS avg_place
FROM e JOIN m ON e.day = m.day GROUP BY e.day, event_type"""

SQL["comp_tiers_hold"] = f"""
SELECT game_version, level, itemsets, play_rate, avg_place, win, top4, true AS nearest, true AS in_order FROM ({SQL["comp_stats"]})
WHERE play_rate IS NOT NULL AND avg_place IS NOT NULL AND win IS NOT NULL AND top4 IS NOT NULL"""

STRENGTHS = f"""
  strength AS (
    SELECT game_version, CAST(split_part(game_version, '.', 1) AS INTEGER) * 1000 + CAST(split_part(game_version, '.', 2) AS INTEGER) AS v, level,
      list_sort(list_distinct(combine_units)) AS itemsets, avg(placement) AS place
    FROM comps GROUP BY ALL HAVING count(placement) >= {FORECAST_BOARDS}),
  numbered_versions AS (SELECT v, row_number() OVER (ORDER BY v) AS no FROM (SELECT DISTINCT
      CAST(split_part(game_version, '.', 1) AS INTEGER) * 1000 + CAST(split_part(game_version, '.', 2) AS INTEGER) AS v FROM comps)),
  numbered_strength AS (SELECT s.*, no FROM strength s JOIN numbered_versions n ON s.v = n.v),
  pairs AS (
    SELECT s.no, s.place, b.place AS last_place FROM numbered_strength s
    JOIN numbered_strength b ON b.no = s.no - 1 AND b.level = s.level AND b.itemsets = s.itemsets),
  newest AS (SELECT max(no) AS no FROM numbered_strength)"""
SQL["comp_forecast"] = (
    comps_with(STRENGTHS)
    + f"""SELECT game_version, level, {text("itemsets")} AS itemsets, {r("place", 6)} AS place,
  {r("place * (SELECT regr_slope(place, last_place) FROM pairs) + (SELECT regr_intercept(place, last_place) FROM pairs)", 6)} AS expected_place
FROM numbered_strength WHERE no = (SELECT no FROM newest) AND (SELECT count(*) FROM pairs) >= 2"""
)
SQL["comp_forecast_error"] = (
    comps_with(
        STRENGTHS,
        """
  line AS (SELECT regr_slope(place, last_place) AS a, regr_intercept(place, last_place) AS b FROM pairs WHERE no < (SELECT no FROM newest))""",
    )
    + f"""SELECT count(*) AS n_tested, {r("any_value(a)", 6)} AS slope, {r("any_value(b)", 6)} AS intercept,
  {r("sqrt(avg((place - (a * last_place + b)) ** 2))", 6)} AS error, {r("sqrt(avg((place - last_place) ** 2))", 6)} AS error_unchanged
FROM pairs, line WHERE no = (SELECT no FROM newest)"""
)

"""Common table expressions used by the SQL side of the registered queries."""

from __future__ import annotations

from draftlake.operators.drafts import STANDARD_TEMPLATE

AS_OF = "2001-08-01"
HORIZON = f"CAST(epoch(DATE '{AS_OF}' - INTERVAL 6 MONTH) AS BIGINT)"


def _template() -> str:
    seat = {0: 0, 1: 0}
    rows = []
    for slot, phase, is_ban, side in STANDARD_TEMPLATE:
        k = 0
        if not is_ban:
            k, seat[side] = seat[side], seat[side] + 1
        rows.append(f"({slot}, '{phase}', {'false' if is_ban else 'true'}, {side}, {k})")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") v(slot, phase, is_pick, side, seat)"


_COMPETITIVE = "league_id > 0 AND lobby IN (1, 2)"
_TEAMS = "coalesce(team0 <> 0 AND team1 <> 0, false)"

# name -> (names it needs, body)
PARTS: dict[str, tuple[list[str], str]] = {
    "contests": ([], """SELECT o_orderkey AS contest_id, CAST(epoch(o_orderdate) AS BIGINT) AS start_time,
        CAST(year(o_orderdate) AS INTEGER) AS season_id,
        CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS side0_won,
        CASE WHEN o_orderpriority <> '5-LOW' THEN 1 ELSE 0 END AS league_id,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS lobby,
        o_custkey AS team0, o_custkey + 1 AS team1 FROM orders"""),
    "seasons": ([], """SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season_id,
        'season ' || year(o_orderdate) AS season_name,
        CAST(epoch(make_date(year(o_orderdate), 1, 1)) AS BIGINT) AS release_at FROM orders"""),
    "comp": (["contests"], f"SELECT * FROM contests WHERE {_COMPETITIVE}"),
    "eligible": (["comp"], f"""SELECT * FROM comp WHERE {_TEAMS} AND side0_won IS NOT NULL
        AND start_time >= {HORIZON}"""),
    "eligible_all": (["comp"], f"SELECT * FROM comp WHERE {_TEAMS} AND side0_won IS NOT NULL"),
    "lines": ([], """SELECT l.*, CAST(substr(p_brand, 7) AS INTEGER) AS item_id
        FROM lineitem l JOIN part ON p_partkey = l_partkey"""),
    "line_steps": (["lines"], """SELECT contest_id, CAST(row_number() OVER (PARTITION BY contest_id
        ORDER BY l_linenumber, item_id) - 1 AS INTEGER) AS slot, is_pick, item_id, side FROM (
        SELECT l_orderkey AS contest_id, l_linenumber, l_returnflag <> 'A' AS is_pick, item_id,
          CAST(l_suppkey % 2 AS INTEGER) AS side, row_number() OVER (PARTITION BY l_orderkey, item_id
          ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS rn FROM lines) WHERE rn = 1"""),
    "line_seats": (["lines"], """SELECT contest_id, CAST(side * 128 + seat AS INTEGER) AS player_slot,
        nullif(l_suppkey, 0) AS account_id, item_id, side FROM (
        SELECT l_orderkey AS contest_id, CAST(l_partkey % 2 AS INTEGER) AS side, l_linenumber % 5 AS seat,
          l_suppkey, item_id, row_number() OVER (PARTITION BY l_orderkey, l_partkey % 2, l_linenumber % 5
          ORDER BY l_suppkey, item_id) AS rn FROM lines) WHERE rn = 1"""),
    "line_players": (["line_seats", "contests"], """SELECT s.*, start_time, season_id, lobby, league_id,
        CASE WHEN side = 0 THEN side0_won ELSE NOT side0_won END AS won
        FROM line_seats s JOIN contests USING (contest_id)"""),
    "line_items": ([], """SELECT CAST(substr(p_brand, 7) AS INTEGER) AS item_id, min(p_brand) AS item_name
        FROM part GROUP BY 1"""),
    "template": ([], _template()),
    "seq_steps": (["template"], """SELECT o_orderkey AS contest_id, slot,
        is_pick AND NOT (slot = 7 AND o_orderkey % 13 = 0) AS is_pick,
        CAST((slot * (o_orderkey % 126 + 1) + o_orderkey) % 127 + 1 AS INTEGER) AS item_id, side
        FROM orders, template WHERE is_pick OR (o_orderkey * 31 + slot * 7) % 11 <> 0"""),
    "seq_seats": (["template"], """SELECT o_orderkey AS contest_id,
        CAST(side * 128 + seat AS INTEGER) AS player_slot,
        nullif((o_custkey + side) * 5 + seat, 0) AS account_id,
        CAST((slot * (o_orderkey % 126 + 1) + o_orderkey) % 127 + 1 AS INTEGER) AS item_id, side
        FROM orders, template WHERE is_pick"""),
    "seq_players": (["seq_seats", "contests"], """SELECT s.*, start_time, season_id, lobby, league_id,
        CASE WHEN side = 0 THEN side0_won ELSE NOT side0_won END AS won
        FROM seq_seats s JOIN contests USING (contest_id)"""),
    "seq_items": ([], """SELECT item_id, item_name, CASE item_id % 5 WHEN 0 THEN 'str' WHEN 1 THEN 'agi'
        WHEN 2 THEN 'int' WHEN 3 THEN 'all' ELSE '' END AS primary_attr, roles FROM (
        SELECT CAST(p_partkey % 127 + 1 AS INTEGER) AS item_id, min(p_name) AS item_name,
          list_sort(list(DISTINCT p_type)) AS roles FROM part GROUP BY 1)"""),
}
for _v in ("line", "seq"):
    for _e in ("eligible", "eligible_all"):
        _n = f"{_v}_picks" if _e == "eligible" else f"{_v}_picks_all"
        PARTS[_n] = ([f"{_v}_steps", _e], f"""SELECT s.contest_id, s.side, s.item_id, side0_won,
            CASE WHEN side = 0 THEN team0 ELSE team1 END AS team_id,
            CASE WHEN side = 0 THEN side0_won ELSE NOT side0_won END AS won
            FROM {_v}_steps s JOIN {_e} USING (contest_id) WHERE is_pick AND item_id > 0""")


def shrunk(p: int) -> str:
    return f"(CAST(sum(CAST(won AS INTEGER)) AS BIGINT) + {p}.0::DOUBLE) / (count(*) + {2 * p}.0::DOUBLE)"


def rate_cols(p: int) -> str:
    return ("count(*) AS games, CAST(sum(CAST(won AS INTEGER)) AS BIGINT) AS wins, "
            f"{shrunk(p)} AS shrunk_wr")


def _profiles(v: str, suffix: str) -> None:
    picks = f"{v}_picks{suffix}"
    PARTS[f"{v}_team_item{suffix}"] = ([picks, f"{v}_items"], f"""SELECT team_id, item_id, item_name,
        {rate_cols(3)} FROM {picks} JOIN {v}_items USING (item_id) GROUP BY ALL""")
    PARTS[f"{v}_synergy{suffix}"] = ([picks, f"{v}_items"], f"""SELECT a.item_id AS item_a,
        ia.item_name AS item_a_name, b.item_id AS item_b, ib.item_name AS item_b_name,
        {rate_cols(3).replace('won', 'a.won')} FROM {picks} a JOIN {picks} b
        ON a.contest_id = b.contest_id AND a.side = b.side AND a.item_id < b.item_id
        JOIN {v}_items ia ON ia.item_id = a.item_id JOIN {v}_items ib ON ib.item_id = b.item_id GROUP BY ALL""")
    PARTS[f"{v}_counter{suffix}"] = ([picks, f"{v}_items"], f"""SELECT a.item_id AS item_a,
        ia.item_name AS item_a_name, b.item_id AS item_b, ib.item_name AS item_b_name,
        {rate_cols(3).replace('won', 'a.won')} FROM {picks} a JOIN {picks} b
        ON a.contest_id = b.contest_id AND a.side <> b.side AND a.item_id <> b.item_id
        JOIN {v}_items ia ON ia.item_id = a.item_id JOIN {v}_items ib ON ib.item_id = b.item_id GROUP BY ALL""")
    window = f" AND start_time >= {HORIZON}" if suffix == "" else ""
    PARTS[f"{v}_actor_item{suffix}"] = ([f"{v}_players", f"{v}_items"], f"""SELECT account_id, item_id, item_name,
        {rate_cols(5)} FROM {v}_players JOIN {v}_items USING (item_id)
        WHERE lobby IN (1, 2, 5, 6, 7) AND account_id IS NOT NULL AND won IS NOT NULL AND item_id > 0{window}
        GROUP BY ALL""")
    PARTS[f"{v}_actor_team{suffix}"] = ([f"{v}_seats", "comp"], f"""SELECT account_id,
        CASE WHEN side = 0 THEN team0 ELSE team1 END AS team_id, count(*) AS games,
        CAST(sum(coalesce(CAST(CASE WHEN side = 0 THEN side0_won ELSE NOT side0_won END AS INTEGER), 0)) AS BIGINT) AS wins,
        max(start_time) AS last_contest_time, max(season_id) AS last_season_id
        FROM {v}_seats JOIN comp USING (contest_id)
        WHERE account_id IS NOT NULL AND {_TEAMS}{window} GROUP BY ALL""")


for _v in ("line", "seq"):
    for _s in ("", "_all"):
        _profiles(_v, _s)


def sql(needs: str, body: str) -> str:
    """``body`` preceded by the named parts and everything they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for d in PARTS[name][0]:
            visit(d)
        ordered.append(name)

    for n in needs.split():
        visit(n)
    if not ordered:
        return body
    head = "WITH " + ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in ordered)
    body = body.strip()
    return head + (",\n" + body[4:] if body[:5].upper() == "WITH " else "\n" + body)

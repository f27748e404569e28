"""For each query, SQL that DuckDB runs on the same tables to check its result."""

from __future__ import annotations

from rallybook.fixtures import BROKEN_NAME_SQL, MATCHES_SQL, PLAYERS_SQL, TABLES, UNTIDY_SQL

NAMES = {t: t for t in TABLES}

# Building blocks, each a common table expression; a query names the ones it needs.
BLOCKS = {
    "p": PLAYERS_SQL.format(**NAMES),
    "m": MATCHES_SQL.format(**NAMES),
    # Both sides of each match.
    "s": """
select cast(winner_id as bigint) as player_id, true as won, tourney_id, tourney_level, round,
 cast(cast(w_bpSaved as double) as int) as bp_saved, cast(cast(w_bpFaced as double) as int) as bp_faced,
 winner_name as name
from m
union all
select cast(loser_id as bigint), false, tourney_id, tourney_level, round,
 cast(cast(l_bpSaved as double) as int), cast(cast(l_bpFaced as double) as int), loser_name
from m
""",
    "players": """
select distinct cast(player_id as bigint) as player_id, name_first, name_last,
 cast(try_strptime(cast(cast(try_cast(dob as double) as int) as varchar), '%Y%m%d') as date) as dob,
 ioc as country, name_first || ' ' || name_last as full_name
from p where name_first is not null and name_last is not null
""",
    "lost": "select player_id, count(*) as matches_lost from s where not won group by player_id",
    "beat": "select player_id, count(*) as matches_won from s where won group by player_id",
    "win_loss": """
select *, round(matches_won / matches_played * 100, 2) as "win_%"
from (select coalesce(lost.player_id, beat.player_id) as player_id, matches_lost, matches_won,
       matches_lost + matches_won as matches_played
      from lost full join beat on lost.player_id = beat.player_id) c
""",
    "win_loss_zero": """
select *, round(matches_won / matches_played * 100, 2) as "win_%"
from (select player_id, coalesce(matches_lost, 0) as matches_lost,
       coalesce(matches_won, 0) as matches_won,
       coalesce(matches_lost, 0) + coalesce(matches_won, 0) as matches_played from win_loss) c
""",
    "bp_won": """
select player_id, round(cast(sum(bp_saved) as bigint) / nullif(cast(sum(bp_faced) as bigint), 0) * 100, 2)
 as "carrer_wins_bp_saved_%"
from s where won group by player_id
""",
    "bp_lost": """
select player_id, round(cast(sum(bp_saved) as bigint) / nullif(cast(sum(bp_faced) as bigint), 0) * 100, 2)
 as "carrer_losses_bp_saved_%"
from s where not won group by player_id
""",
    "bp_career": """
select coalesce(bp_lost.player_id, bp_won.player_id) as player_id,
 "carrer_losses_bp_saved_%", "carrer_wins_bp_saved_%",
 ((cast(round("carrer_wins_bp_saved_%" * 100) as bigint)
   + cast(round("carrer_losses_bp_saved_%" * 100) as bigint) + 1) // 2) / 100.0
  as "carrer_avg_bp_saved_%"
from bp_lost full join bp_won on bp_lost.player_id = bp_won.player_id
""",
    "entered": """
select player_id, count(distinct tourney_id) as tournaments_played from s group by player_id
""",
    "in_final": """
select player_id, count(distinct tourney_id) as finals_played from s where round = 'F' group by player_id
""",
    "won_final": """
select player_id, count(distinct tourney_id) as finals_won from s where round = 'F' and won
group by player_id
""",
}

CAREER = """
select players.*, matches_lost, matches_won, matches_played, "win_%",
 "carrer_losses_bp_saved_%", "carrer_wins_bp_saved_%", "carrer_avg_bp_saved_%",
 finals_played, finals_won, tournaments_played,
 round(finals_played / nullif(tournaments_played, 0) * 100, 2) as "finals_played_%",
 round(finals_won / nullif(finals_played, 0) * 100, 2) as "finals_win_%",
 round(finals_won / nullif(tournaments_played, 0) * 100, 2) as "tournament_win_%"
from players left join win_loss using (player_id) left join bp_career using (player_id)
 left join in_final using (player_id) left join won_final using (player_id)
 left join entered using (player_id)
"""

CAREER_ZERO = """
select players.*, coalesce(matches_lost, 0) as matches_lost, coalesce(matches_won, 0) as matches_won,
 coalesce(matches_played, 0) as matches_played, "win_%",
 "carrer_losses_bp_saved_%", "carrer_wins_bp_saved_%", "carrer_avg_bp_saved_%",
 coalesce(finals_played, 0) as finals_played, coalesce(finals_won, 0) as finals_won,
 coalesce(tournaments_played, 0) as tournaments_played,
 round(coalesce(finals_played, 0) / nullif(tournaments_played, 0) * 100, 2) as "finals_played_%",
 round(coalesce(finals_won, 0) / nullif(finals_played, 0) * 100, 2) as "finals_win_%",
 round(coalesce(finals_won, 0) / nullif(tournaments_played, 0) * 100, 2) as "tournament_win_%"
from players left join win_loss_zero using (player_id) left join bp_career using (player_id)
 left join in_final using (player_id) left join won_final using (player_id)
 left join entered using (player_id)
"""

RAW_COLUMNS = (
    "tourney_id, tourney_level, round, year, winner_id, winner_name, loser_id, loser_name, "
    "w_bpSaved, w_bpFaced, l_bpSaved, l_bpFaced"
)


def level_sql(level: str, counts: str, rates: str) -> str:
    return f"""
select *, round({counts}_won / {counts}_played * 100, 2) as "{rates}_win_%",
 round({counts}_matches_won / {counts}_matches_played * 100, 2) as "{rates}_matches_win_%"
from (select player_id, count(distinct tourney_id) as {counts}_played,
       nullif(count(*) filter (where won and round = 'F'), 0) as {counts}_won,
       count(*) as {counts}_matches_played,
       nullif(count(*) filter (where won), 0) as {counts}_matches_won
      from s where tourney_level = '{level}' group by player_id) c
"""


def pivot_sql(levels: str) -> str:
    columns = [
        f"count(*) filter (where {condition} and tourney_level = '{level}') as matches_{name}_{level}"
        for level in levels
        for name, condition in (("won", "won"), ("lost", "not won"))
    ]
    return f"select player_id, {', '.join(columns)} from s group by player_id"


def respelled(side: str) -> str:
    return f"case when full_name <> {side}_name then full_name else {side}_name end as {side}_name"


def with_blocks(body: str, *names: str) -> str:
    blocks = ",\n".join(f"{name} as ({BLOCKS[name]})" for name in names)
    return f"with {blocks}\n{body}"


SIDES = ("m", "s")
WIN_LOSS = (*SIDES, "lost", "beat", "win_loss")
BREAK_POINTS = ("bp_won", "bp_lost", "bp_career")
FINALS = ("in_final", "won_final", "entered")
CAREER_BLOCKS = ("p", "players", *WIN_LOSS, *BREAK_POINTS, *FINALS)

SILVER_MATCHES = """
select tourney_id, tourney_level, round, year, cast(winner_id as bigint) as winner_id,
 case when winner_name <> w.full_name then w.full_name else winner_name end as winner_name,
 cast(loser_id as bigint) as loser_id,
 case when loser_name <> l.full_name then l.full_name else loser_name end as loser_name,
 w_bpSaved, w_bpFaced, l_bpSaved, l_bpFaced
from m left join (select player_id, min(full_name) as full_name from players group by player_id) w
  on cast(m.winner_id as bigint) = w.player_id
 left join (select player_id, min(full_name) as full_name from players group by player_id) l
  on cast(m.loser_id as bigint) = l.player_id
"""

NAME_CANDIDATES = f"""
select distinct player_id, name_first, name_last, dob, country, full_name,
 winner_id, {respelled("winner")}, loser_id, {respelled("loser")}
from players
 left join (select distinct player_id as winner_id, name as winner_name from s where won) w
  on player_id = winner_id
 left join (select distinct player_id as loser_id, name as loser_name from s where not won) l
  on player_id = loser_id
"""

BACKFILL = """
, found as (select player_id, min(name) as name from s where name is not null group by player_id),
filled as (
 select p.player_id, dob, ioc,
  coalesce(name_first,
   case when ends_with(name, ' ' || name_last) and length(name) > length(name_last) + 1
        then substr(name, 1, length(name) - length(name_last) - 1) end,
   case when instr(name, ' ') > 1 then substr(name, 1, instr(name, ' ') - 1) end) as name_first,
  coalesce(name_last,
   case when starts_with(name, name_first || ' ') and length(name) > length(name_first) + 1
        then substr(name, length(name_first) + 2) end,
   case when instr(name, ' ') > 1 and instr(name, ' ') < length(name)
        then substr(name, instr(name, ' ') + 1) end) as name_last
 from p left join found on cast(p.player_id as bigint) = found.player_id)
select distinct cast(player_id as bigint) as player_id, name_first, name_last,
 cast(try_strptime(cast(cast(try_cast(dob as double) as int) as varchar), '%Y%m%d') as date) as dob,
 ioc as country, name_first || ' ' || name_last as full_name
from filled where name_first is not null and name_last is not null
"""

GOLD_MATCHES = """
select tourney_id, tourney_level, round, year, winner_id, winner_name, loser_id, loser_name,
 cast(cast(w_bpSaved as double) as int) as w_bpSaved, cast(cast(w_bpFaced as double) as int) as w_bpFaced,
 cast(cast(l_bpSaved as double) as int) as l_bpSaved, cast(cast(l_bpFaced as double) as int) as l_bpFaced
from m
"""

PLAYER_TOURNAMENTS = """
select player_id, tourney_id, tourney_level,
 count(*) filter (where won) as won, count(*) filter (where not won) as lost,
 count(*) filter (where won and round = 'F') as finals_won,
 count(*) filter (where not won and round = 'F') as finals_lost,
 cast(sum(bp_saved) filter (where won) as bigint) as won_bp_saved,
 cast(sum(bp_faced) filter (where won) as bigint) as won_bp_faced,
 cast(sum(bp_saved) filter (where not won) as bigint) as lost_bp_saved,
 cast(sum(bp_faced) filter (where not won) as bigint) as lost_bp_faced
from s group by player_id, tourney_id, tourney_level
"""

LOSS_RATES = """
select player_id,
 round(nullif(count(*) filter (where not won), 0)
       / (nullif(count(*) filter (where not won), 0) + nullif(count(*) filter (where won), 0)) * 100, 2)
  as "loss_%",
 nullif(count(*) filter (where not won and tourney_level = 'G'), 0) as gs_matches_lost
from s group by player_id
"""

UNION_BY_NAME = f"""
select {RAW_COLUMNS.replace("year", "cast(year as varchar) as year").replace("l_bpFaced", "")}
 case when year % 3 = 2 then null else l_bpFaced end as l_bpFaced
from m
"""

LANDED = """
select 'atp_matches_' || year || '.csv' as name, count(*) as landed_rows from m group by year
union all select 'atp_players.csv', count(*) from p
"""

MISSING = """
select distinct 'atp_matches_' || year || '.csv' as name from m where year % 2 <> 0
union all select 'atp_players.csv'
"""

NO_DATE = "try_strptime(cast(cast(try_cast(dob as double) as int) as varchar), '%Y%m%d') is null"

REJECTED = f"""
select 'dob' as "column", dob as value, count(*) as "rows" from p where {NO_DATE} and dob is not null group by dob
union all
select 'l_bpFaced', value, count(*) from (select {UNTIDY_SQL} as value from m) x
where trim(value) <> '' and try_cast(value as double) is null group by value
"""

UNREAD_COLUMNS = {
    "p": {"player_id": "player_id", "dob": "dob"},
    "m": {c: c for c in ("winner_id", "loser_id", "w_bpSaved", "w_bpFaced", "l_bpSaved")} | {"l_bpFaced": UNTIDY_SQL},
}

UNREAD = "select *, round(unread / nullif(\"values\", 0) * 100, 2) as \"unread_%\" from (" + " union all ".join(
    f"""select '{name}' as "column", count(*) filter (where trim({value}) <> '') as "values",
     count(*) filter (where trim({value}) <> '' and {NO_DATE if name == 'dob' else f'try_cast({value} as double) is null'}) as unread
    from {table}"""
    for table, columns in UNREAD_COLUMNS.items()
    for name, value in columns.items()
) + ") u"

REPORT = f"""
select 'players' as "table", 'read' as finding, cast(null as varchar) as "column", count(*) as "rows" from p
union all select 'matches', 'read', null, count(*) from m
union all select 'players', 'unread', 'dob', count(*) from p where {NO_DATE} and dob is not null
union all select 'players', 'unread', 'player_id', 0
union all select 'matches', 'unread', unnest(['winner_id', 'loser_id', 'w_bpSaved', 'w_bpFaced', 'l_bpSaved', 'l_bpFaced']), 0
union all select 'players', 'repeated', 'player_id', count(*)
 from (select player_id from players group by player_id having count(*) > 1) r
"""

GS_SQL = with_blocks(level_sql("G", "gs", "gs"), *SIDES)
CAREER_SQL = with_blocks(CAREER, *CAREER_BLOCKS)

ORACLE_SQL: dict[str, str] = {
    "silver_players": with_blocks("select * from players", "p", "players"),
    "silver_matches": with_blocks(SILVER_MATCHES, "p", "players", "m"),
    "distinct_names": with_blocks("select distinct won, player_id, name from s", *SIDES),
    "name_corrections": with_blocks(
        "select distinct s.player_id, name, full_name from s join "
        "(select player_id, min(full_name) as full_name from players group by player_id) c "
        "on s.player_id = c.player_id where name <> full_name",
        "p",
        "players",
        *SIDES,
    ),
    "name_candidates": with_blocks(NAME_CANDIDATES, "p", "players", *SIDES),
    "backfill_names": with_blocks(BACKFILL, "p", *SIDES),
    "player_lookup": with_blocks(
        "select player_id from players where full_name in "
        "('Customer 000000001', 'Customer 000000042', 'Customer 000000099')",
        "p",
        "players",
    ),
    "match_sides": with_blocks("select * from s", *SIDES),
    "gold_matches": with_blocks(GOLD_MATCHES, "m"),
    "losses": with_blocks("select * from lost", *SIDES, "lost"),
    "wins": with_blocks("select * from beat", *SIDES, "beat"),
    "win_loss": with_blocks("select * from win_loss", *WIN_LOSS),
    "win_loss_joined": with_blocks("select * from win_loss", *WIN_LOSS),
    "win_loss_zero_filled": with_blocks("select * from win_loss_zero", *WIN_LOSS, "win_loss_zero"),
    "bp_saved_won": with_blocks("select * from bp_won", *SIDES, "bp_won"),
    "bp_saved_lost": with_blocks("select * from bp_lost", *SIDES, "bp_lost"),
    "bp_saved_career": with_blocks("select * from bp_career", *SIDES, *BREAK_POINTS),
    "bp_saved_career_won_key": with_blocks(
        """select bp_won.player_id, bp_career.* exclude (player_id)
        from bp_career left join bp_won on bp_career.player_id = bp_won.player_id""",
        *SIDES,
        *BREAK_POINTS,
    ),
    "bp_saved_career_joined": with_blocks("select * from bp_career", *SIDES, *BREAK_POINTS),
    "tournaments_played": with_blocks("select * from entered", *SIDES, "entered"),
    "finals_rows": with_blocks(
        "select distinct player_id, tourney_id from s where round = 'F'", *SIDES
    ),
    "finals_played": with_blocks("select * from in_final", *SIDES, "in_final"),
    "finals_won": with_blocks("select * from won_final", *SIDES, "won_final"),
    "player_tournaments": with_blocks(PLAYER_TOURNAMENTS, *SIDES),
    "player_statistics": CAREER_SQL,
    "player_statistics_zero_filled": with_blocks(CAREER_ZERO, *CAREER_BLOCKS, "win_loss_zero"),
    "player_statistics_joined": CAREER_SQL,
    "gs_played": with_blocks(
        "select player_id, count(distinct tourney_id) as gs_played from s "
        "where tourney_level = 'G' group by player_id",
        *SIDES,
    ),
    "gs_won": with_blocks(
        "select player_id, count(*) as gs_won from s "
        "where tourney_level = 'G' and round = 'F' and won group by player_id",
        *SIDES,
    ),
    "gs_matches_played": with_blocks(
        "select player_id, count(*) as gs_matches_played from s "
        "where tourney_level = 'G' group by player_id",
        *SIDES,
    ),
    "gs_matches_won": with_blocks(
        "select player_id, count(*) as gs_matches_won from s "
        "where tourney_level = 'G' and won group by player_id",
        *SIDES,
    ),
    "gs_statistics": GS_SQL,
    "gs_statistics_joined": GS_SQL,
    "masters_statistics": with_blocks(level_sql("M", "masters_1000", "masters_1000"), *SIDES),
    "davis_statistics": with_blocks(level_sql("D", "davis_cup", "davis"), *SIDES),
    "loss_rates": with_blocks(LOSS_RATES, *SIDES),
    "level_pivot": with_blocks(pivot_sql("ADFGM"), *SIDES),
    "csv_roundtrip": with_blocks("select * from p", "p"),
    "line_breaks": with_blocks(
        f"""select * replace (case when cast(player_id as int) % 3 = 0 then name_last else {BROKEN_NAME_SQL} end
         as name_last) from p""",
        "p",
    ),
    "yearly_files_load": with_blocks(
        f"select {RAW_COLUMNS}, 'atp_matches_' || year || '.csv' as path from m", "m"
    ),
    "yearly_list_load": with_blocks(f"select {RAW_COLUMNS.replace('year, ', '')} from m", "m"),
    "all_matches": with_blocks(f"select {RAW_COLUMNS.replace('year, ', '')} from m", "m"),
    "manifest": with_blocks(
        """select name, '/raw/' || name as path from (
          select 'atp_matches_' || unnest(range(min(year), max(year) + 1)) || '.csv' as name from m
          union all select 'atp_players.csv') n""",
        "m",
    ),
    "bronze_relanding": with_blocks(
        "select 'atp_matches_' || year || '.csv' as name, count(*) as landed_rows from m group by year", "m"
    ),
    "player_lookup_indexed": with_blocks(
        "select player_id from players where full_name in "
        "('Customer 000000001', 'Customer 000000042', 'Customer 000000099')",
        "p",
        "players",
    ),
    "rejected_values": with_blocks(REJECTED, "p", "m"),
    "unread_counts": with_blocks(UNREAD, "p", "m"),
    "streaming_counts": with_blocks(PLAYER_TOURNAMENTS, *SIDES),
    "streaming_matches": with_blocks(
        "select 'atp_matches_' || year || '.csv' as name, year, count(*) as landed_rows from m group by year", "m"
    ),
    "pipeline_report": with_blocks(REPORT, "p", "players", "m"),
    "incremental_run": with_blocks(
        f"select * from ({CAREER}) c left join ({LOSS_RATES}) l using (player_id)", *CAREER_BLOCKS
    ),
    "incremental_gs": GS_SQL,
    "incremental_years": with_blocks(
        """select year, case when year = (select max(year) from m) then 2 else 1 end as written_in, count(*) as matches
        from m group by year""",
        "m",
    ),
    "changed_source": with_blocks(
        """select 'atp_matches_' || year || '.csv' as name, count(*) * (case when late then 2 else 1 end) as landed_rows,
         late as landed_again
        from (select year, year = (select max(year) from m) as late from m) x group by year, late""",
        "m",
    ),
    "failed_replacement": with_blocks("select * from players", "p", "players"),
    "pipeline_level_pivot": with_blocks(pivot_sql("ADFGM"), *SIDES),
    "yearly_union_by_name": with_blocks(UNION_BY_NAME, "m"),
    "bronze_landing": with_blocks(LANDED, "p", "m"),
    "missing_sources": with_blocks(MISSING, "m"),
    "pipeline_gold": GS_SQL,
    "pipeline_player_statistics": with_blocks(
        f"select * from ({CAREER}) c left join ({LOSS_RATES}) l using (player_id)", *CAREER_BLOCKS
    ),
}

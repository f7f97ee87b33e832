"""Further queries: what the runs of the pipeline do with their tables, and the SQL they are checked by."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from dugoutline.functions import dates as D
from dugoutline.functions import text as T
from dugoutline.functions import values as V
from dugoutline.operators import dedup, links, promote, roster, signals, topics
from dugoutline.plans import adapt as A
from dugoutline.plans import sql as S
from dugoutline.plans.catalog import _GATE, _ROWS, REF, _attention, _seq_numbers, day, query
from dugoutline.session import table
from dugoutline.sources import pages, store

# --- merging and inserting --------------------------------------------------------------------------------

_FILL = ("player_id", "name_kana", "category", "throws", "bats", "height_cm", "weight_kg", "birth_date", "fastball_max", "description", "team", "team_name", "school_year")
_KEYED = f"""(select *, coalesce({S.player_key('name')}, '') as n, coalesce({S.school_key("coalesce(nullif(team, ''), team_name)")}, '') as s from player_candidates)"""
_SOME = lambda c: f"nullif(cast({c} as varchar), '')"
_RANKED_SQL = f"""(select *, row_number() over (partition by n, s order by {_SOME('player_id')} is null, -case status when 'promoted' then 3 when 'pending' then 2 when 'rejected' then 1 else 0 end, -coalesce(source_count, 0), created_at nulls first, id) as r,
count(*) over (partition by n, s) as members, first_value(id) over (partition by n, s order by {_SOME('player_id')} is null, -case status when 'promoted' then 3 when 'pending' then 2 when 'rejected' then 1 else 0 end, -coalesce(source_count, 0), created_at nulls first, id) as survivor from {_KEYED})"""


@query(f"""with g as {_RANKED_SQL}, f as (select n, s, max(nullif(draft_year, 0)) as latest, arg_min(draft_year, id) filter (where draft_year is not null) as some_year, arg_min(positions, id) filter (where len(positions) > 0) as positions, {', '.join(f"arg_min({c}, id) filter (where {_SOME(c)} is not null) as {c}" for c in _FILL)} from g group by n, s)
select g.id, g.members, {', '.join(f"case when {_SOME('g.' + c)} is not null then g.{c} else coalesce(f.{c}, g.{c}) end as {c}" for c in _FILL)}, array_to_string(case when len(g.positions) > 0 then g.positions else coalesce(f.positions, g.positions) end, ',') as positions,
case when {_SOME('g.player_id')} is null and f.latest is not null then case when f.player_id is null then f.latest else case when {_SOME('g.player_id')} is null then f.latest end end else coalesce(g.draft_year, f.some_year) end as draft_year from g join f using (n, s) where g.r = 1""")
def candidate_merge_full(spark, d):
    kept = dedup.merged_candidates(A.candidates(spark, d))["kept"]
    return kept.select("id", "members", *_FILL, F.array_join("positions", ",").alias("positions"), "draft_year")


@query(f"with m as (select id, survivor, first_value({_SOME('player_id')}) over (partition by n, s order by r) as pid, members from {_RANKED_SQL} as g where true) select c.id, coalesce(m.survivor, c.player_candidate_id) as player_candidate_id, coalesce(m.pid, c.player_id) as player_id from scout_comments c left join (select * from m where members > 1 and id <> survivor) m on m.id = c.player_candidate_id")
def candidate_merge_children(spark, d):
    moved = dedup.merged_candidates(A.candidates(spark, d))["moved"].select(F.col("id").alias("_c"), "survivor", F.col("player_id").alias("_p"))
    c = A.comments(spark, d).select("id", "player_id", "player_candidate_id")
    return c.join(moved, F.col("player_candidate_id") == F.col("_c"), "left").select("id", F.coalesce("survivor", "player_candidate_id").alias("player_candidate_id"), F.coalesce("_p", "player_id").alias("player_id"))


@query(f"select id from {_RANKED_SQL} where r = 1")
def candidates_without_losers(spark, d):
    c = A.candidates(spark, d)
    return store.without(c, dedup.merged_candidates(c)["moved"], "id").select("id")


_OF_TEAM = "coalesce(player_id, 'c:' || player_candidate_id, 't:' || team_name)"


@query(f"select id from scout_comments where update_at is not null and {S.loose('comment')} <> '' and ({_OF_TEAM}, {S.loose('comment')}) not in (select ({_OF_TEAM}, {S.loose('comment')}) from scout_comments where update_at is null and {_OF_TEAM} is not null)")
def comment_insert_dedup(spark, d):
    ref = dedup.comment_ref(F.col("player_id"), F.col("player_candidate_id"), F.col("team_name"))
    c = A.comments(spark, d).select("id", "update_at", ref.alias("ref"), T.loose_comment_key(F.col("comment")).alias("loose")).where("loose <> ''")
    return c.where("update_at is not null").join(c.where("update_at is null").select("ref", "loose").distinct(), ["ref", "loose"], "left_anti").select("id")


@query(f"select a.url, r.evidence_hash, min(r.pos) as pos from ({_ROWS}) r join crawled_articles a using (id) where a.url <> '' and (a.url, r.evidence_hash) not in (select (source_url, md5(comment)) from scout_comments where source_url is not null and comment is not null) group by 1, 2")
def attention_insert_dedup(spark, d):
    urls = A.articles(spark, d).select("id", "url").where("url <> ''")
    new = _attention(spark, d).join(urls, "id").groupBy("url", "evidence_hash").agg(F.min("pos").alias("pos"))
    stored = A.comments(spark, d).select(F.col("source_url").alias("url"), F.md5("comment").alias("evidence_hash")).where("url is not null and evidence_hash is not null").distinct()
    return new.join(stored, ["url", "evidence_hash"], "left_anti")


_SRC = "select player_candidate_id as ref, coalesce(source_url, '') as url, coalesce(md5(comment), '') as evidence, id from scout_comments where player_candidate_id is not null and"


@query(f"select id from ({_SRC} update_at is not null) where (ref, url, evidence) not in (select (ref, url, evidence) from ({_SRC} update_at is null))")
def source_exclusion(spark, d):
    c = A.comments(spark, d).where("player_candidate_id is not null").select("id", F.col("player_candidate_id").alias("ref"), F.col("source_url").alias("url"), F.md5("comment").alias("evidence"), "update_at")
    return links.not_stored(c.where("update_at is not null"), c.where("update_at is null"), ["ref", "url", "evidence"]).select("id")


@query("""with k as (select coalesce(url, '') as u, count(*) as n from crawled_articles where source <> 'まとめポータル' group by 1), s as (select distinct coalesce(url, '') as u from crawled_articles where source = 'まとめポータル')
select sum(n)::bigint as told, sum(n - 1)::bigint as repeated, count(s.u) as stored, count_if(s.u is null) as inserted from k left join s using (u)""")
def insert_report(spark, d):
    a = A.articles(spark, d)
    return links.insert_report(a.where("source <> 'まとめポータル'"), a.where("source = 'まとめポータル'"), ["url"])


@query("""with n as (select url, title, id from crawled_articles where trim(url) <> '' and trim(title) <> '' and id >= '8' qualify row_number() over (partition by url order by id desc) = 1), o as (select url, min(id) as id, min(title) as title from crawled_articles where id < '8' and url <> '' group by url)
select url, title, id from n union all select url, title, id from o where url not in (select url from n)""")
def upsert_required_titles(spark, d):
    a = A.articles(spark, d).select("id", "url", "title")
    stored = a.where("id < '8' and url <> ''").groupBy("url").agg(F.min("id").alias("id"), F.min("title").alias("title"))
    return store.planned_upsert(stored, a.where("id >= '8'"), ["url"], [], ("title",))[0].select("url", "title", "id")


@query()
def incoming_vs_stored(spark, d):
    """The later half of the articles against the earlier one: new, update of a stored one, or dropped."""
    a = _seq_numbers(spark, d)
    half = a.agg(F.percentile_approx("seq", 0.5).alias("_h"))
    sided = a.join(F.broadcast(half), F.lit(True))
    return dedup.against_stored(sided.where("seq > _h").drop("_h"), sided.where("seq <= _h").drop("_h"), 0.8, V.TEST_PRIORITIES, A.articles(spark, d))


# --- names and people -------------------------------------------------------------------------------------

_BARE = lambda c: f"nullif({S.sub(c, S.SPACE, '')}, '')"


@query(f"""with k as (select id, {_BARE('name')} as k, 1 as p from players union all select id, {_BARE('name_kana')}, 2 from players), b as (select k, arg_min(id, (p, id)) as id from k where k is not null group by k),
n as (select distinct player_name as name, {_BARE('player_name')} as k from scout_comments where player_name is not null)
select n.name, coalesce(b.id, (select min(p.id) from players p where contains(lower(p.name), lower(n.k)) or contains(lower(p.name_kana), lower(n.k)))) as player_id from n left join b using (k)""")
def name_lookup_anywhere(spark, d):
    return links.name_lookup_anywhere(A.comments(spark, d).where("player_name is not null").select(F.col("player_name").alias("name")), table(spark, d, "players"))


_KNOWN = "select replace(name, ' ', '') from players where name is not null"


@query(f"select id, true as registered from scout_comments where replace(player_name, ' ', '') in ({_KNOWN}) union all select id, false from scout_comments where player_name is null or replace(player_name, ' ', '') not in ({_KNOWN})")
def registered_semi_anti(spark, d):
    known = table(spark, d, "players").select(F.replace("name", F.lit(" "), F.lit("")).alias("k")).where("k is not null").distinct()
    c = A.comments(spark, d).select("id", F.replace("player_name", F.lit(" "), F.lit("")).alias("k"))
    return c.join(known, "k", "left_semi").select("id", F.lit(True).alias("registered")).unionByName(c.join(known, "k", "left_anti").select("id", F.lit(False).alias("registered")))


@query(f"select c.id, min(k.id) as known_id from {_KEYED} c join {_KEYED} k on c.n = k.n and c.s = k.s and c.id > k.id where c.n <> '' group by c.id")
def candidate_key_match(spark, d):
    c = A.candidates(spark, d).select("id", T.player_key(F.col("name")).alias("n"), F.coalesce(T.school_key(F.coalesce(F.nullif("team", F.lit("")), "team_name")), F.lit("")).alias("s")).where("n is not null")
    first = c.groupBy("n", "s").agg(F.min("id").alias("known_id"))
    return c.join(first, ["n", "s"]).where("id > known_id").select("id", "known_id")


_POSITION = "array_to_string(positions, '、')"


@query(f"""select id, array_to_string(case when p is null or trim(p) = '' then null when contains(p, '投手') and contains(p, '外野手') then ['投手', '外野手'] when contains(p, '投手') and contains(p, '内野手') then ['投手', '内野手'] when contains(p, '投手') and contains(p, '捕手') then ['投手', '捕手']
when contains(p, '捕手') then ['捕手'] when contains(p, '内野手') then ['内野手'] when contains(p, '外野手') then ['外野手'] when contains(p, '投手') then ['投手'] else [p] end, ',') as positions from (select id, {_POSITION} as p from player_candidates)""")
def position_backfill(spark, d):
    return A.candidates(spark, d).select("id", F.array_join(T.position_list(F.array_join("positions", "、")), ",").alias("positions"))


# --- scalars ----------------------------------------------------------------------------------------------


@query(f"""select doc_id, nullif({S.clean(S.sub(S.sub('text', chr(92) + '[([^' + chr(92) + ']]*)' + chr(92) + ']' + chr(92) + '([^)]*' + chr(92) + ')', chr(92) + '1'), '[#*_`>~]', ''))}, '') as excerpt from documents""")
def document_excerpts(spark, d):
    return table(spark, d, "documents").select("doc_id", T.plain_excerpt(F.col("text")).alias("excerpt"))


@query("select id, case when regexp_full_match(left(published_at, 10), '[0-9]{4}-[0-9]{2}-[0-9]{2}') then cast(try_strptime(left(published_at, 10), '%Y-%m-%d') as date) end as event_date, strftime(timezone('UTC', created_at), '%m-%d') <= '10-31' as in_season from crawled_articles")
def event_dates_and_season(spark, d):
    return A.articles(spark, d).select("id", D.event_date(F.col("published_at")).alias("event_date"), T.in_season(day(F.col("created_at")), "10-31").alias("in_season"))


_WORDS = ("SCOUT", "Draft", "ドラフト", "球団", "mlb")


@query(f"select doc_id, {S.contains_any('lower(text)', [w.lower() for w in _WORDS])} as hit from documents")
def keywords_any_case(spark, d):
    return table(spark, d, "documents").select("doc_id", T.contains_any_case(F.col("text"), _WORDS).alias("hit"))


@query(f"""select id, 'INSERT INTO scout_comments (id, team_name, scout_name, comment) VALUES (' || concat_ws(', ', {', '.join(f"coalesce('''' || replace({c}, '''', '''''') || '''', 'NULL')" for c in ('id', 'team_name', 'scout_name', 'comment'))}) || ');' as statement from scout_comments""")
def insert_statements(spark, d):
    return A.comments(spark, d).select("id", T.inserted_values("scout_comments", {c: F.col(c) for c in ("id", "team_name", "scout_name", "comment")}).alias("statement"))


@query("""with c as (select id, nullif(cast(draft_year as varchar), '') as y, nullif(category, '') as c, nullif(positions[1], '') as theme, nullif(name, '') as n, nullif(team, '') as a, nullif(team_name, '') as b, cast(cast(timezone('UTC', created_at) as date) as varchar) as d from player_candidates)
select id, kind, case kind when 'player_watch' then 'player_watch:' || coalesce(y, 'unknown') || ':' || n || ':' || d when 'scout_meeting' then 'scout_meeting:' || a || ':' || d || ':' || coalesce(y, 'unknown')
when 'game_report' then 'game_report:' || d || ':' || case when encode(a) <= encode(b) then a || ':' || b else b || ':' || a end when 'ranking' then 'ranking:' || coalesce(y, 'unknown') || ':' || c || ':' || theme else 'other:' || n end as key
from c, (select unnest(['player_watch', 'scout_meeting', 'game_report', 'ranking', 'other']) as kind)""")
def topic_key_forms(spark, d):
    kinds = F.explode(F.array(*map(F.lit, ("player_watch", "scout_meeting", "game_report", "ranking", "other"))))
    c = A.candidates(spark, d).select("*", kinds.alias("kind"))
    key = T.topic_key(F.col("kind"), year=F.nullif(F.col("draft_year").cast("string"), F.lit("")), player=F.col("name"), date=day(F.col("created_at")), team=F.col("team"), team_b=F.col("team_name"), category=F.col("category"), theme=F.get("positions", F.lit(0)), title=F.col("name"))
    return c.select("id", "kind", key.alias("key"))


@query()
def full_timestamps(spark, d):
    """Every date text as a time of the clock it tells, in whatever notation; what tells none is left as it is."""
    return A.articles(spark, d).select("id", D.full_timestamp_text(F.col("published_at")).alias("timestamp_text"))


# --- topics -----------------------------------------------------------------------------------------------

_SIGNALS = f"(select id, coalesce(player_id, player_candidate_id) as player, {S.day('published_at')} as day, team_name, created_at from scout_comments where player_id is not null or player_candidate_id is not null)"
_OPENED = f"(select player, min(id) as topic_id, min(created_at) as created_at, list_distinct(list(day) filter (where day is not null)) as days, case when min(id) < 'c' then 'draft' else 'published' end as status from {_SIGNALS} group by player, team_name)"


@query(f"""with t as (select *, row_number() over (partition by player order by created_at desc, topic_id desc) as r from {_OPENED} where status = 'draft')
select s.id as signal_id, arg_min(t.topic_id, t.r) as topic_id from {_SIGNALS} s join t using (player) where t.r <= 20 and (s.day is null or len(list_filter(t.days, lambda e: abs(date_diff('day', e, s.day)) <= 3)) > 0) group by 1""")
def nearest_topics(spark, d):
    c = A.comments(spark, d).select("id", F.coalesce("player_id", "player_candidate_id").alias("player"), day(F.col("published_at")).alias("day"), "team_name", "created_at").where("player is not null")
    status = F.when(F.min("id") < "c", "draft").otherwise("published")
    opened = c.groupBy("player", "team_name").agg(F.min("id").alias("topic_id"), F.min("created_at").alias("created_at"), F.collect_set("day").alias("event_days"), status.alias("status"))
    kind = F.lit("player_watch").alias("topic_type")
    return topics.nearest_topics(c.select(F.col("id").alias("signal_id"), kind, "player", "day"), opened.select("topic_id", kind, "player", "status", "created_at", "event_days"))


_TOLD = f"(select r.*, a.url, a.title, a.source, coalesce(nullif(a.category, ''), 'none') as topic, {S.day('a.created_at')} as day, r.id || lpad(cast(r.pos as varchar), 6, '0') as seq from ({_ROWS}) r join (select id, url, title, source, category, created_at from crawled_articles) a using (id))"


@query(f"""with m as {_TOLD}, k as (select topic, unnest(string_split(team_keys, ',')) as k from m union select coalesce(nullif(a.category, ''), 'none'), s.team_name from scout_comments s join crawled_articles a on a.url = s.source_url),
u as (select topic, url, arg_min(title, seq) filter (where title is not null) as title, arg_min(source, seq) as source from m where url is not null group by 1, 2), e as (select distinct topic, coalesce(cast(day as varchar), '') as date, sentence from m)
select m.topic, max(team_count) as team_count, max(person_count) as person_count, bool_or(has_mlb) as has_mlb, any_value(t.teams) as teams, any_value(s.sources) as sources, any_value(v.events) as events, max(score) + cast(greatest(0, least(any_value(s.n) - 1, 3)) as int) + case when bool_or(meeting) then 2 else 0 end as importance
from m left join (select topic, string_agg(distinct k, ',' order by k) as teams from k where k <> '' group by 1) t using (topic) left join (select topic, count(*) as n, string_agg(url, ',' order by url) as sources from u group by 1) s using (topic)
left join (select topic, md5(string_agg(date || sentence, chr(10) order by date, encode(sentence))) as events from e group by 1) v using (topic) group by m.topic""")
def topic_summary_full(spark, d):
    of = F.coalesce(F.nullif("category", F.lit("")), F.lit("none")).alias("topic")
    a = A.articles(spark, d)
    rows = _attention(spark, d).join(a.select("id", "url", F.col("title"), "source", of, day(F.col("created_at")).alias("day")), "id")
    members = rows.select("topic", "url", "title", "source", "day", F.col("sentence").alias("evidence"), "team_count", "person_count", "team_keys", "has_mlb", "score", "meeting", F.concat("id", F.lpad(F.col("pos").cast("string"), 6, "0")).alias("seq"))
    visits = A.comments(spark, d).select("source_url", F.col("team_name").alias("team")).join(a.select("url", of), F.col("source_url") == F.col("url")).select("topic", "team")
    s = topics.summarised(members, visits)
    events = F.md5(F.array_join(F.transform("events", lambda e: F.concat(e["date"], e["summary"])), "\n"))
    return s.select("topic", "team_count", "person_count", "has_mlb", F.array_join("teams", ",").alias("teams"), F.array_join(F.transform("sources", lambda x: x["url"]), ",").alias("sources"), events.alias("events"), "importance")


_OLD = "select team_name as topic, list(url order by url) as urls from (select distinct team_name, source_url as url from scout_comments where update_at is null and source_url is not null) group by 1"


@query(f"""with o as ({_OLD}), n as (select team_name as topic, source_url as url, min(id) as seq from scout_comments where update_at is not null and source_url is not null group by 1, 2), f as (select n.topic, list(n.url order by n.seq, n.url) as urls from n left join o on o.topic = n.topic where o.urls is null or not list_contains(o.urls, n.url) group by 1)
select coalesce(o.topic, f.topic) as topic, array_to_string(list_concat(coalesce(o.urls, []), coalesce(f.urls, [])), ',') as urls from o full join f on o.topic = f.topic""")
def topic_url_merge(spark, d):
    c = A.comments(spark, d).where("source_url is not null").select(F.col("team_name").alias("topic"), F.col("source_url").alias("url"), F.col("id").alias("seq"), "update_at")
    old = c.where("update_at is null").groupBy("topic").agg(F.array_sort(F.collect_set("url")).alias("urls"))
    return topics.merged_urls(old, c.where("update_at is not null")).select("topic", F.array_join("urls", ",").alias("urls"))


# --- rosters ----------------------------------------------------------------------------------------------

_RKEY = f"coalesce(category, '') || '|' || {S.name_key('name')} || '|' || {S.school_match_key('school')}"
_TICKED = f"(select distinct {_RKEY} as key from roster_entries where season = 2025 and draft_eligible and name is not null)"


@query(f"""with r as (select distinct coalesce(category, '') as category, {_RKEY} as key, name || '（' || coalesce(school, '') || '）' as label, season is null as fresh from roster_entries where name is not null), l as (select category, label, key, key in (select key from {_TICKED}) as t, fresh from r)
select category, string_agg('- [' || case when t then 'x' else ' ' end || '] ' || case when fresh then '🆕 ' else '' end || label || ' <!--k:' || key || '-->', chr(10) order by encode(label), encode(key), fresh desc) as markdown, count_if(t) as ticked from l group by category""")
def roster_tracker(spark, d):
    r = table(spark, d, "roster_entries").where("name is not null")
    key = T.entry_key(F.col("category"), F.col("name"), F.col("school"))
    label = F.concat("name", F.lit("（"), F.coalesce("school", F.lit("")), F.lit("）"))
    records = r.select(F.coalesce("category", F.lit("")).alias("category"), key.alias("key"), label.alias("label"), F.col("season").isNull().alias("fresh")).distinct()
    before = r.where("season = 2025 and draft_eligible").select(F.concat(F.lit("- [x] <!--k:"), key, F.lit("-->")).alias("markdown"))
    return roster.checklist(records, before, "category")


_MD = lambda i: f"coalesce(try_cast(regexp_extract(received_date, '(\\d{{1,2}})月(\\d{{1,2}})日', {i}) as int), 0)"


@query(f"select category, '| name | school | received |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| ' || concat_ws(' | ', coalesce(name, '-'), coalesce(school, '-'), coalesce(received_date, '-')) || ' |', chr(10) order by -{_MD(1)}, -{_MD(2)}, encode(school) nulls first, encode(name) nulls first, entry_id) as markdown from roster_entries group by category")
def roster_newest_first(spark, d):
    return roster.markdown_table(table(spark, d, "roster_entries"), ["name", "school", "received"], ["name", "school", "received_date"], [*roster.newest_first(F.col("received_date")), F.col("school"), F.col("name"), F.col("entry_id")], "category")


@query("""select category, category || '：届け出' || cast(count(*) as varchar) || '人（対象' || cast(count_if(draft_eligible) as varchar) || '人）' as title, string_agg(distinct school, '、' order by school) as excerpt from roster_entries where category is not null group by category""")
def roster_heads(spark, d):
    r = table(spark, d, "roster_entries").where("category is not null").groupBy("category").agg(F.count("*").alias("n"), F.count_if("draft_eligible").alias("e"), F.array_sort(F.collect_set("school")).alias("s"))
    return r.select("category", F.concat("category", F.lit("：届け出"), F.col("n").cast("string"), F.lit("人（対象"), F.col("e").cast("string"), F.lit("人）")).alias("title"), F.array_join("s", "、").alias("excerpt"))


# --- promotion --------------------------------------------------------------------------------------------

def _payloads(spark, d):
    """Payloads as a researcher writes them, made of what the candidates have."""
    c = A.candidates(spark, d)
    line = lambda season, games: F.create_map(F.lit("season"), season, F.lit("year"), F.col("draft_year").cast("string"), F.lit("games"), games.cast("string"), F.lit("unknown"), F.lit("x"))
    stats = F.array(line(F.when(F.col("fastball_max") > 145, "fall").otherwise("winter"), F.col("height_cm")), line(F.lit("spring"), F.col("weight_kg")))
    player = F.create_map(F.lit("name"), F.col("name"), F.lit("draft_year"), F.col("draft_year").cast("string"), F.lit("category"), F.col("category"))
    honours = F.array(F.create_map(F.lit("result"), F.col("description"), F.lit("year"), F.col("draft_year").cast("string"), F.lit("unknown"), F.lit("x")))
    return c.select(F.col("id").alias("candidate_id"), "status", "player_id", F.to_json(F.struct(player.alias("player"), stats.alias("stats"), honours.alias("achievements"))).alias("payload"))


def _commit(spark, d):
    return promote.committed(_payloads(spark, d), table(spark, d, "players").select(F.col("id").alias("player_id"), "name", "draft_year"))


_DONE = f"(select c.*, {S.name_key('c.name')} as k from player_candidates c where c.player_id is null and c.status <> 'promoted')"
_FRESH = f"(select * from {_DONE} where id not in (select c.id from {_DONE} c join (select draft_year, {S.name_key('name')} as k from players) p using (k) where c.k <> '' and (c.draft_year is null or p.draft_year is null or c.draft_year = p.draft_year)))"
_PERIOD = "case category " + " ".join(f"when {S.quote(k)} then {S.quote(v)}" for k, v in promote.CATEGORY_CODES.items()) + " else category end"


@query(f"""select player_id, pos, period, name, value from (select id as player_id, {_PERIOD} as period, cast(u.pos as int) as pos, unnest(['season', 'year', 'games']) as name, unnest([u.season, cast(draft_year as varchar), cast(u.games as varchar)]) as value
from (select *, unnest([{{'pos': 0, 'season': case when fastball_max > 145 then 'fall' end, 'games': height_cm}}, {{'pos': 1, 'season': 'spring', 'games': weight_kg}}]) as u from {_FRESH}) where u.season is not null) where value is not null""")
def promotion_stats(spark, d):
    return _commit(spark, d)["stats"].select("player_id", "pos", "period", "name", "value")


@query(f"select player_id, pos, name, value from (select id as player_id, 0 as pos, unnest(['result', 'year']) as name, unnest([description, cast(draft_year as varchar)]) as value from {_FRESH}) where value is not null")
def promotion_achievements(spark, d):
    return _commit(spark, d)["achievements"]


@query(f"select id as player_id, name, draft_year, 0 as rank_code from {_FRESH}")
def promotion_committed(spark, d):
    return _commit(spark, d)["players"]


@query(f"with l as (select id as candidate_id, id as player_id from {_FRESH} union all select c.id, min(p.id) from {_DONE} c join (select id, draft_year, {S.name_key('name')} as k from players) p using (k) where c.k <> '' and (c.draft_year is null or p.draft_year is null or c.draft_year = p.draft_year) group by c.id) select s.id, coalesce(s.player_id, l.player_id) as player_id, s.player_candidate_id from scout_comments s left join l on l.candidate_id = s.player_candidate_id")
def promotion_child_links(spark, d):
    return links.promoted_links(A.comments(spark, d).select("id", "player_id", "player_candidate_id"), _commit(spark, d)["links"])


# --- visits, votes, marks ---------------------------------------------------------------------------------


@query(f"select {REF} as ref, count(*) as visits, count(distinct team_name) as teams, max({S.day('published_at')}) as last_day, string_agg(distinct team_name, ',' order by team_name) as team_list from scout_comments where {REF} is not null group by 1")
def player_visit_summary(spark, d):
    ref = dedup.visit_ref(F.col("player_id"), F.col("player_candidate_id"), F.col("player_name"))
    c = A.comments(spark, d).select(ref.alias("ref"), "team_name", day(F.col("published_at")).alias("day")).where("ref is not null")
    return c.groupBy("ref").agg(F.count("*").alias("visits"), F.countDistinct("team_name").alias("teams"), F.max("day").alias("last_day"), F.array_join(F.array_sort(F.collect_set("team_name")), ",").alias("team_list"))


@query(f"select team_name as team, id, cast(r as int) as place from (select team_name, id, row_number() over (partition by team_name order by {S.day('published_at')} desc nulls last, created_at desc nulls last, id) as r from scout_comments) where r <= 30")
def team_timeline(spark, d):
    w = Window.partitionBy("team_name").orderBy(F.desc_nulls_last("day"), F.desc_nulls_last("created_at"), "id")
    c = A.comments(spark, d).select("id", "team_name", "created_at", day(F.col("published_at")).alias("day"))
    return c.withColumn("place", F.row_number().over(w)).where("place <= 30").select(F.col("team_name").alias("team"), "id", "place")


@query(f"with v as (select distinct {REF} as ref, team_name as team from scout_comments where update_at is not null and {REF} is not null) select {REF} as ref, team_name as team, arg_max(id, (coalesce(source_url, '') <> '', coalesce(epoch_us(published_at), 0), id)) as id from scout_comments where {REF} is not null and ({REF}, team_name) not in (select (ref, team) from v) group by 1, 2")
def visit_backfill(spark, d):
    ref = dedup.visit_ref(F.col("player_id"), F.col("player_candidate_id"), F.col("player_name"))
    c = A.comments(spark, d).withColumns({"ref": ref, "published_at": F.lpad(F.coalesce(F.unix_micros("published_at"), F.lit(0)).cast("string"), 20, "0")})
    known = c.where("update_at is not null and ref is not null").select("ref", F.col("team_name").alias("team")).distinct()
    return links.representative_per_pair(c, F.col("ref"), F.col("team_name")).join(known, ["ref", "team"], "left_anti")


_WEIGHTS = {"purchase": 5, "signup": 4, "click": 2, "view": 1, "error": 0}


@query(f"with e as (select user_id, {S.case('event_type', _WEIGHTS, '1')} as w, ts, max(ts) over () as now from events) select user_id, cast(sum(w) as bigint) as votes, count(*) as recent, round(avg(w), 6) as mean from e where ts > now - interval 7 day group by user_id")
def votes_of_last_week(spark, d):
    e = table(spark, d, "events")
    recent = e.join(F.broadcast(e.agg(F.max("ts").alias("_now"))), F.col("ts") > F.col("_now") - F.expr("interval 7 days"))
    w = F.coalesce(T.looked_up(_WEIGHTS, F.col("event_type")), F.lit(1))
    return recent.groupBy("user_id").agg(F.sum(w).alias("votes"), F.count("*").alias("recent"), F.round(F.avg(w), 6).alias("mean"))


@query("select id from scout_comments where created_at > coalesce((select max(created_at) from player_candidates where status = 'rejected'), timestamptz '2026-06-01 00:00:00+00' - interval 30 hour)")
def signals_since_mark(spark, d):
    marks = A.candidates(spark, d).where("status = 'rejected'")
    return links.since_mark(A.comments(spark, d), marks, "created_at", "2026-06-01 00:00:00+00:00").select("id")


@query("select id from scout_comments where created_at > timestamptz '2026-06-01 00:00:00+00' - interval 30 hour")
def signals_without_mark(spark, d):
    return links.since_mark(A.comments(spark, d), A.candidates(spark, d).where("false"), "created_at", "2026-06-01 00:00:00+00:00").select("id")


# --- sources: pages written from the tables and read again ------------------------------------------------


def _escaped(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


_PRINTED = lambda c: S.strip(S.sub(c, "[\\x00-\\x1f\\x{7f}]", ""))


@query(f"select source, cast(pos - 1 as int) as pos, url as link, title, nullif(published_at, '') as date from (select source, url, {_PRINTED('title')} as title, {_PRINTED('published_at')} as published_at, row_number() over (partition by source order by id) as pos from crawled_articles where source is not null and url is not null and title is not null and published_at is not null)")
def feed_source(spark, d):
    """A feed of each outlet with all its articles, read again."""
    printed = lambda c: T.strip(F.regexp_replace(c, "[\\x00-\\x1f\\x7f]", ""))
    a = A.articles(spark, d).where("source is not null and url is not null and title is not null and published_at is not null")
    item = F.concat(F.lit("<item><title>"), _escaped(printed(F.col("title"))), F.lit("</title><link>"), _escaped(F.col("url")), F.lit("</link><pubDate>"), _escaped(printed(F.col("published_at"))), F.lit("</pubDate></item>"))
    lines = F.array_sort(F.collect_list(F.struct("id", item.alias("item"))))
    feeds = a.groupBy(F.col("source").alias("url")).agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.transform(lines, lambda x: x["item"]), ""), F.lit("</channel></rss>")).alias("xml"))
    return pages.feed_items(feeds).select(F.col("url").alias("source"), "pos", "link", F.trim("title").alias("title"), "date")


@query("select cast(table_id as varchar) as url, cast(row_number() over (partition by table_id order by pos, entry_id) - 1 as int) as pos, coalesce(trim(regexp_replace(name, '[\\s\\x{3000}]+', ' ', 'g')), '') as name, coalesce(trim(regexp_replace(school, '[\\s\\x{3000}]+', ' ', 'g')), '') as school from roster_entries")
def roster_source(spark, d):
    """A page of each published table, read again."""
    r = table(spark, d, "roster_entries")
    cell = lambda c: F.concat(F.lit("<td>"), _escaped(F.coalesce(c, F.lit(""))), F.lit("</td>"))
    line = F.concat(F.lit("<tr>"), cell(F.col("name")), cell(F.col("school")), F.lit("</tr>"))
    rows = F.array_sort(F.collect_list(F.struct("pos", "entry_id", line.alias("line"))))
    html = F.concat(F.lit("<h2>名簿</h2><table><tr><th>氏名</th><th>学校名</th></tr>"), F.array_join(F.transform(rows, lambda x: x["line"]), ""), F.lit("</table>"))
    got = pages.roster_rows(r.groupBy(F.col("table_id").cast("string").alias("url")).agg(html.alias("html")))
    clean = lambda i: T.clean_text(F.get("cells", F.lit(i)))
    return got.select("url", "pos", clean(0).alias("name"), clean(1).alias("school"))


@query("select source as url, url as link, cast(row_number() over (partition by source order by first_id) - 1 as int) as pos from (select source, url, min(id) as first_id from crawled_articles where source is not null and contains(url, '/article/') and not ends_with(url, '/') group by 1, 2)")
def list_source(spark, d):
    """The list page of each outlet: links to its articles, each once, in their order."""
    a = A.articles(spark, d).where("source is not null and url is not null")
    link = F.concat(F.lit('<a href="'), _escaped(F.col("url")), F.lit('">'), F.col("id"), F.lit("</a>"))
    lines = F.array_sort(F.collect_list(F.struct("id", link.alias("link"))))
    lists = a.groupBy(F.col("source").alias("url")).agg(F.array_join(F.transform(lines, lambda x: x["link"]), "\n").alias("html"))
    return pages.page_links(lists, "https://list.example/", contains="/article/", not_ending="/")


@query("select id, title, body from crawled_articles where length(title) > 10 and length(body) > 50")
def stored_contents(spark, d):
    a = A.articles(spark, d).select("id", "title", "body")
    known = store.first_available(a.where("false"), a)
    return known.where((F.length("title") > 10) & (F.length("body") > 50))


@query("select id, 'status' as rule from player_candidates where status not in ('promoted', 'approved', 'pending', 'rejected') union all select id, 'confidence' from player_candidates where not latest_confidence between 0 and 1 union all select id, 'source_count' from player_candidates where source_count < 2 union all select id, 'passed' from player_candidates where coalesce(status in ('promoted', 'approved', 'pending', 'rejected'), true) and coalesce(latest_confidence between 0 and 1, true) and coalesce(source_count >= 2, true)")
def validated_candidates(spark, d):
    good, bad = store.validated(A.candidates(spark, d), store.candidate_rules() | {"source_count": F.col("source_count") >= 2})
    return good.select("id", F.lit("passed").alias("rule")).unionByName(bad.select("id", F.explode("broken_rules").alias("rule")))


@query(f"select a.id, {_GATE} as attention, count(r.id) as sentences from crawled_articles a left join ({_ROWS}) r using (id) group by a.id, a.title, a.body")
def gated_signals(spark, d):
    a = A.articles(spark, d)
    text = F.concat(F.coalesce("title", F.lit("")), F.lit("\n\n"), F.coalesce("body", F.lit("")))
    n = _attention(spark, d).groupBy("id").agg(F.count("*").alias("_n"))
    return a.select("id", signals.has_attention(text).alias("attention")).join(n, "id", "left").select("id", "attention", F.coalesce("_n", F.lit(0)).alias("sentences"))

"""Queries of the core operators and the SQL they are checked by.

Each query runs over its whole tables. Where SQL can't tell the result (compatibility forms, look-ahead,
sequence ratios, replays) there is none, and a test compares with brute force on a small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dugoutline.functions import dates as D
from dugoutline.functions import text as T
from dugoutline.functions import values as V
from dugoutline.functions.timestamps import article_instants
from dugoutline.operators import dedup, entity, links, promote, roster, signals, timeline, topics
from dugoutline.plans import adapt as A
from dugoutline.plans import sql as S
from dugoutline.session import checkpointed, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
AGGREGATOR = "まとめポータル"
CLUBS, CLUB_ORDER = V.TEST_CLUBS, tuple(V.TEST_CLUBS)
REF = f"coalesce(player_id, 'c:' || player_candidate_id, 'n:' || {S.player_key('player_name')})"
PRIORITY = S.case("source", V.TEST_PRIORITIES, "5")


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def day(ts):
    """UTC day of an instant."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_micros(ts) / 86_400_000_000).cast("int"))


@query()
def p6_found(spark, d):
    return article_instants(table(spark, d, "crawled_articles"))


# --- timeline ---------------------------------------------------------------------------------------------

_TITLE = "nullif(lower(regexp_replace(coalesce(title, ''), '[\\s\\x{3000}]', '', 'g')), '')"


def _dated_articles(spark, d) -> DataFrame:
    """Articles with the instant of publication as text in UTC; null where it can't be read."""
    a = A.articles(spark, d)
    at = article_instants(a).groupBy("article_id").agg(F.max("published_utc").alias("published_at"))
    return a.select(F.col("id").alias("article_id"), "url", "title", "source", "category").join(at, "article_id", "left")


def _instant_text(ts):
    """UTC text of a timestamp, whatever the session's zone."""
    s = F.pmod(F.floor(F.unix_micros(ts) / 1_000_000), F.lit(86_400)).cast("int")
    clock = [F.lpad(F.floor(x).cast("string"), 2, "0") for x in (s / 3600, s % 3600 / 60, s % 60)]
    return F.concat(day(ts).cast("string"), F.lit("T"), clock[0], F.lit(":"), clock[1], F.lit(":"), clock[2], F.lit("Z"))


def _quoted(spark, d, art, clock) -> DataFrame:
    """Comments on people with the time they were said, else that of their article."""
    c = A.comments(spark, d).where("player_id is not null or player_candidate_id is not null").withColumn("_said", clock(F.col("published_at"))).drop("published_at")
    with_article = c.join(art.withColumnRenamed("category", "a_category"), F.col("source_url") == F.col("url"), "left")
    return timeline.branch(with_article, "scout_comment", player_id=F.col("player_id"), player_candidate_id=F.col("player_candidate_id"), crawled_article_id=F.col("article_id"), source_url=F.col("source_url"), title=F.col("title"), published_at=F.coalesce("_said", "published_at"), source=F.col("source"), category=F.col("a_category"), body=F.concat_ws(" ", "team_name", "scout_name", "comment"), created_at=F.col("created_at"))


def _published_articles(spark, d) -> DataFrame:
    """Articles with the time of publication as the store keeps it: the clock of the page, null where it is no date."""
    # the clock is a column of its own, so that it is read once
    read = A.articles(spark, d).withColumn("_clock", D.wall_clock(F.col("published_at")))
    kept = F.when(F.try_to_timestamp("_clock").isNotNull(), F.concat(F.replace("_clock", F.lit(" "), F.lit("T")), F.lit("+09:00")))
    return read.select(F.col("id").alias("article_id"), "url", "title", "source", "category", kept.alias("published_at"))


def _clock_text(ts):
    """A timestamp as its clock in Japan with the offset, whatever the session's zone."""
    return F.concat(F.substring(_instant_text(F.timestamp_micros(F.unix_micros(ts) + 32_400_000_000)), 1, 19), F.lit("+09:00"))


def _news(spark, d, art) -> DataFrame:
    """News of candidates, and of registered players, whose items have no candidate."""
    told = A.evidence(spark, d).join(art.select(F.col("article_id").alias("_a"), "title", "source", "category", "published_at"), F.col("article_id") == F.col("_a"), "left")
    common = {"crawled_article_id": F.col("article_id"), "source_url": F.col("url"), "title": F.col("title"), "published_at": F.col("published_at"), "source": F.col("source"), "category": F.col("category"), "body": F.col("name"), "confidence": F.col("confidence"), "created_at": F.col("created_at"), "player_id": F.col("player_id")}
    return timeline.branch(told.where("player_id is null"), "candidate", player_candidate_id=F.col("candidate_id"), **common).unionByName(timeline.branch(told.where("player_id is not null"), "player_article", **common))


def _timeline(spark, d) -> DataFrame:
    """News of candidates once per person and title, and their comments, with the time of publication."""
    art = _published_articles(spark, d)
    told = A.evidence(spark, d).join(art.select(F.col("article_id").alias("_a"), "title", "source", "category", "published_at"), F.col("article_id") == F.col("_a"), "left")
    items = timeline.branch(told, "candidate", player_id=F.col("player_id"), player_candidate_id=F.col("candidate_id"), crawled_article_id=F.col("article_id"), source_url=F.col("url"), title=F.col("title"), published_at=F.col("published_at"), source=F.col("source"), category=F.col("category"), body=F.col("name"), confidence=F.col("confidence"), created_at=F.col("created_at"))
    return timeline.news_once(items, AGGREGATOR).unionByName(_quoted(spark, d, art, _clock_text))


_PUBLISHED = f"case when try_cast({S.wall_clock('a.published_at')} as timestamp) is not null then replace({S.wall_clock('a.published_at')}, ' ', 'T') || '+09:00' end"
_OF_NEWS = f"order by case when starts_with(source, '{AGGREGATOR}') then 1 else 0 end, published_at desc nulls last, created_at nulls last, source_url nulls first, player_candidate_id nulls first"
_QUOTED_SQL = """select s.player_id, s.player_candidate_id, a.id, s.source_url, a.title, coalesce({said}, a.published_at), a.source, a.category, 'scout_comment', concat_ws(' ', s.team_name, s.scout_name, s.comment), null, null, epoch_us(s.created_at)
from scout_comments s left join art a on a.url = s.source_url where s.player_id is not null or s.player_candidate_id is not null""".format(said=S.instant_text("s.published_at"))
_TIMELINE_SQL = f"""
with art as (select a.id, a.url, a.title, a.source, a.category, {_PUBLISHED} as published_at from crawled_articles a),
n as (select c.player_id, c.id as player_candidate_id, c.crawled_article_id, c.latest_source_url as source_url, a.title, a.published_at, a.source, a.category, 'candidate' as item_type, c.name as body, c.latest_confidence as confidence, c.created_at
  from player_candidates c left join art a on a.id = c.crawled_article_id),
r as (select *, row_number() over (partition by player_id, coalesce({_TITLE}, source_url, crawled_article_id) {_OF_NEWS}) as rn from n)
select player_id, player_candidate_id, crawled_article_id, source_url, title, published_at, source, category, item_type, body, confidence, cast(null as int) as score, epoch_us(created_at) as created_us from r where rn = 1
union all
{_QUOTED_SQL}"""


def _timeline_columns(items: DataFrame) -> DataFrame:
    return items.withColumn("created_us", F.unix_micros("created_at")).drop("created_at").select("player_id", "player_candidate_id", "crawled_article_id", "source_url", "title", "published_at", "source", "category", "item_type", "body", "confidence", "score", "created_us")


@query(_TIMELINE_SQL)
def timeline_union_dedup(spark, d):
    return _timeline_columns(_timeline(spark, d))


@query("select item_type, source, count(*) as items from (" + _TIMELINE_SQL + ") group by all")
def timeline_counts(spark, d):
    return _timeline(spark, d).groupBy("item_type", "source").agg(F.count("*").alias("items"))


# --- scalar normalisers -----------------------------------------------------------------------------------


@query(f"select id, {S.clean('title')} as title_clean, {S.comment_text('body')} as body_text from crawled_articles")
def text_clean(spark, d):
    return A.articles(spark, d).select("id", T.clean_text(F.col("title")).alias("title_clean"), T.comment_text(F.col("body")).alias("body_text"))


@query(f"select id, {S.comment_text('comment')} as plain, lower({S.comment_text('comment')}) as key, {S.loose('comment')} as loose from scout_comments")
def comment_keys(spark, d):
    c = F.col("comment")
    return A.comments(spark, d).select("id", T.comment_text(c).alias("plain"), T.comment_key(c).alias("key"), T.loose_comment_key(c).alias("loose"))


_V = ("".join(V.VARIANTS), "".join(V.VARIANTS.values()))
_SCHOOL = f"regexp_replace(regexp_replace({S.sub('translate(team, ' + S.quote(_V[0]) + ', ' + S.quote(_V[1]) + ')', S.SPACE, '')}, '(大學|大学)$', '大'), '(高等学校|高校)$', '高')"
_ALIASES = {k: "".join(V.VARIANTS.get(c, c) for c in v) for k, v in V.SCHOOL_ALIASES.items()}


@query(f"select id, nullif(lower({S.case(_SCHOOL, _ALIASES, _SCHOOL)}), '') as school from players")
def school_suffix_alias_key(spark, d):
    return table(spark, d, "players").select("id", T.school_form(T.translated(F.col("team"), V.VARIANTS)).alias("school"))


@query(f"select id, {S.player_key('name')} as player_key, {S.name_key('name')} as name_key, {S.kana_key('name_kana')} as kana_key, {S.school_key('coalesce(team, team_name)')} as school_key from player_candidates")
def name_keys(spark, d):
    c = A.candidates(spark, d)
    return c.select("id", T.player_key(F.col("name")).alias("player_key"), T.name_key(F.col("name")).alias("name_key"), T.kana_key(F.col("name_kana")).alias("kana_key"), T.school_key(F.coalesce("team", "team_name")).alias("school_key"))


@query(f"select id, {S.club_key('title', CLUBS)} as club from crawled_articles")
def club_longest_contains(spark, d):
    return A.articles(spark, d).select("id", T.club_key(F.col("title"), CLUBS).alias("club"))


_CLUB_NAMES = {v: k for k, v in CLUBS.items()}


@query(f"select scout_id, case when trim(team_key) <> '' and trim(team_key) <> 'other' then {S.case('trim(team_key)', _CLUB_NAMES, 'trim(team_key)')} end as club from scouts")
def club_display_name(spark, d):
    return table(spark, d, "scouts").select("scout_id", T.club_name(F.col("team_key"), CLUBS, CLUB_ORDER).alias("club"))


def _positions_sql() -> str:
    one = "case " + " ".join(f"when {S.hit('x', '|'.join(w))} then {S.quote(k)}" for k, w in V.POSITIONS.items()) + " else x end"
    return f"coalesce(array_to_string(list_transform(list_filter(positions, lambda x: x is not null and trim(x) <> ''), lambda x: {one}), ','), '')"


@query(f"select id, {S.category('category')} as category_name, {_positions_sql()} as position_names, case when upper(throws) = 'R' or contains(throws, '右') then 'R' when upper(throws) = 'L' or contains(throws, '左') then 'L' end as throw_hand, case when upper(bats) = 'S' or contains(bats, '両') or contains(bats, 'スイッチ') then 'S' when upper(bats) = 'R' or contains(bats, '右') then 'R' when upper(bats) = 'L' or contains(bats, '左') then 'L' end as bat_hand from player_candidates")
def candidate_codes(spark, d):
    return A.candidates(spark, d).select("id", T.category_of(F.col("category")).alias("category_name"), F.array_join(T.positions_of(F.col("positions")), ",").alias("position_names"), T.throws_of(F.col("throws")).alias("throw_hand"), T.bats_of(F.col("bats")).alias("bat_hand"))


@query(f"select id, {S.case('rank_code', {90 - 10 * i: c for i, c in enumerate('SABCDEF')}, chr(39) + '—' + chr(39))} as rank_letter, array_to_string(positions, '・') as position_label, '[' || name || '](/players/' || id || ')' as link from players")
def player_labels(spark, d):
    return table(spark, d, "players").select("id", T.rank_label(F.col("rank_code")).alias("rank_letter"), F.array_join("positions", "・").alias("position_label"), F.concat(F.lit("["), "name", F.lit("](/players/"), "id", F.lit(")")).alias("link"))


@query(f"select id, {S.case('source', V.TEST_PRIORITIES, '5')} as priority, {S.case('source', V.SOURCE_PRIORITIES, '5')} as given_priority from crawled_articles")
def source_priorities(spark, d):
    return A.articles(spark, d).select("id", T.source_priority(F.col("source"), V.TEST_PRIORITIES).alias("priority"), T.source_priority(F.col("source")).alias("given_priority"))


@query(f"select id, md5({S.clean('title')} || chr(10) || {S.clean('body')}) as md5, sha256({S.clean('coalesce(title, chr(32)[2:]) || chr(10) || coalesce(body, chr(32)[2:])')}) as sha256, md5({S.sub('coalesce(nullif(title, chr(32)[2:]), body, chr(32)[2:])', S.SPACE, '')}) as title_md5 from crawled_articles")
def content_hashes(spark, d):
    a = A.articles(spark, d)
    return a.select("id", T.content_md5(F.col("title"), F.col("body")).alias("md5"), T.content_sha256(F.col("title"), F.col("body")).alias("sha256"), T.title_hash(F.col("title"), F.col("body")).alias("title_md5"))


# --- dates ------------------------------------------------------------------------------------------------

_WALL = S.wall_clock("published_at")


@query(f"select id, replace({_WALL}, ' ', 'T') || '+09:00' as timestamp_text, left({_WALL}, 16) as with_time, left({_WALL}, 10) as day from crawled_articles")
def date_cascade(spark, d):
    p = F.col("published_at")
    return A.articles(spark, d).select("id", D.timestamp_text(p).alias("timestamp_text"), D.date_with_time(p).alias("with_time"), D.date_only(p).alias("day"))


@query(r"select entry_id, coalesce(try_cast(regexp_extract(received_date, '(\d{1,2})月(\d{1,2})日', 1) as int), 0) as month, coalesce(try_cast(regexp_extract(received_date, '(\d{1,2})月(\d{1,2})日', 2) as int), 0) as day from roster_entries")
def received_dates(spark, d):
    return table(spark, d, "roster_entries").select("entry_id", D.received_date(F.col("received_date")).alias("r")).select("entry_id", "r.month", "r.day")


_GRADE = r"try_cast(nullif(regexp_extract(school_year, '(\d+)\s*年', 1), '') as int)"


@query(f"""with c as (select id, draft_year, {_GRADE} as grade, cast(year(timezone('UTC', created_at)) as int) as pub, {S.category('category')} as cat, coalesce(description, '') as context from player_candidates)
select id, coalesce(nullif(draft_year, 0), case when grade > 0 and cat = '高校' then pub + greatest(3 - grade, 0) when grade > 0 and cat = '大学' then pub + greatest(4 - grade, 0) when grade in (2, 3) and cat = '社会人' then pub end,
case when regexp_matches(context, '来年(?:の)?ドラフト') then pub + 1 when regexp_matches(context, '今秋ドラフト|今年(?:の)?ドラフト|今ドラフト') then pub end) as draft_year from c""")
def inferred_draft_year(spark, d):
    c = A.candidates(spark, d)
    published = F.year(day(F.col("created_at"))).cast("string")
    return c.select("id", D.draft_year(F.col("draft_year"), published, F.col("school_year"), F.col("category"), F.coalesce("description", F.lit(""))).alias("draft_year"))


# --- gates and signals ------------------------------------------------------------------------------------

_TEXT = "coalesce(title, '') || chr(10) || chr(10) || coalesce(body, '')"
_GATE = f"coalesce(len(list_filter(string_split_regex({_TEXT}, '[。\\n]'), lambda s: {S.attention('s')} and not {S.hit('s', V.NEGATIVE)})) > 0, false)"


@query(f"select id, {_GATE} as attention, {S.contains_any(_TEXT, V.MEETING_WORDS)} as meeting_word, {S.contains_any(_TEXT, V.MEETING_EVENTS)} as meeting_event, {S.hit(_TEXT, V.CANDIDATE)} as candidate_word from crawled_articles")
def keyword_gate_flags(spark, d):
    text = F.concat(F.coalesce("title", F.lit("")), F.lit("\n\n"), F.coalesce("body", F.lit("")))
    a = A.articles(spark, d).withColumn("_t", text)
    t = F.col("_t")
    return a.select("id", signals.has_attention(t).alias("attention"), T.contains_any(t, V.MEETING_WORDS).alias("meeting_word"), T.contains_any(t, V.MEETING_EVENTS).alias("meeting_event"), t.rlike(V.CANDIDATE).alias("candidate_word"))


@query()
def comment_gate(spark, d):
    return signals.annotated(A.articles(spark, d), A.staff(spark, d)).select("id", "gate_scout_comment", "gate_attention", "gate_player_candidate", "gate_keywords")


_SENTENCES = f"""select id, title, cast(u.pos - 1 as int) as pos, {S.clean('u.s')} as sentence from (select id, title, unnest(list_transform(range(1, len(l) + 1), lambda i: {{'pos': i, 's': l[i]}})) as u from (select id, title, string_split_regex(coalesce(nullif(body, ''), title), '[。\\n]') as l from crawled_articles))"""


@query(f"select id, pos, sentence from ({_SENTENCES}) where sentence <> ''")
def sentence_explode(spark, d):
    return signals.sentences(A.articles(spark, d), ["id"]).select("id", "pos", "sentence")


def _keys(x: str) -> str:
    return "list_filter([" + ", ".join(f"case when contains({x}, {S.quote(k)}) then {S.quote(v)} end" for k, v in CLUBS.items()) + "], lambda x: x is not null)"


_PERSONS = "coalesce(" + ", ".join(f"nullif(regexp_extract(sentence, {S.quote(p)}, 1), '')" for p in V.PERSONS) + ")"
_COUNTED = f"""select id, pos, sentence, case when {S.hit('sentence', '全球団|12球団|十二球団')} then 12 else coalesce({S.number(f"nullif(regexp_extract(sentence, '({V.COUNT})球団', 1), '')")}, 0) end as team_count,
coalesce({S.number(_PERSONS)}, 0) as person_count, {_keys('sentence')} as own, {_keys("coalesce(title, '')")} as titled, {S.hit('sentence', V.MAJORS)} as has_mlb, {S.contains_any('sentence', V.MEETING_EVENTS)} as meeting, contains(sentence, 'スカウト') as scout
from ({_SENTENCES}) where sentence <> '' and {S.attention('sentence')} and not {S.hit('sentence', V.NEGATIVE)}"""
_SCORED = f"""select *, case when meeting and len(own) = 0 then titled else own end as k from ({_COUNTED})"""
_BASE = "case when team_count >= 12 then 5 when team_count >= 8 then 4 when team_count >= 5 then 3 when team_count >= 2 then 2 when len(k) > 0 then 2 when person_count > 0 then 1 else 0 end"
_SCORE = f"least({_BASE} + cast(person_count >= 10 as int) + cast(has_mlb as int), 7)"
_ROWS = f"""select id, pos, sentence, team_count, person_count, array_to_string(k, ',') as team_keys, {S.hit('sentence', V.LEAGUE)} or len(k) > 0 as has_npb, has_mlb, meeting, case when {_SCORE} = 0 and (scout or meeting) then 1 else {_SCORE} end as score, md5(sentence) as evidence_hash
from ({_SCORED}) where team_count > 0 or person_count > 0 or len(k) > 0 or has_mlb or scout or meeting"""


def _attention(spark, d):
    return signals.attention_rows(A.articles(spark, d), CLUBS, CLUB_ORDER, quoted=False)


@query(_ROWS)
def sentence_signal_rows(spark, d):
    return _attention(spark, d).withColumn("team_keys", F.array_join("team_keys", ","))


@query(f"select id, max(score) as score, max(team_count) as team_count, max(person_count) as person_count, count(distinct evidence_hash) as sentences from ({_ROWS}) group by id")
def attention_score(spark, d):
    return _attention(spark, d).groupBy("id").agg(F.max("score").alias("score"), F.max("team_count").alias("team_count"), F.max("person_count").alias("person_count"), F.countDistinct("evidence_hash").alias("sentences"))


# --- duplicates and survivors -----------------------------------------------------------------------------


@query("select url, min(id) as id from crawled_articles where url <> '' group by url")
def url_first_dedup(spark, d):
    return dedup.url_first(A.articles(spark, d).select("url", "id"), F.struct("id")).select("url", "id")


_HASH = f"md5({S.clean('title')} || chr(10) || {S.clean('body')})"


@query(f"""with a as (select id, source, {PRIORITY} as prio, case when length(title) > 10 and length(body) > 50 then {_HASH} end as h from crawled_articles)
select id, first_value(id) over (partition by h order by id) as slot from a where h is not null qualify row_number() over (partition by h order by prio, id) = 1 union all select id, id from a where h is null""")
def hash_priority_dedup(spark, d):
    return dedup.hash_priority(A.articles(spark, d).select("id", "source", "title", "body"), F.col("id"), V.TEST_PRIORITIES).select("id", "slot")


@query("select distinct source_url as url from scout_comments where source_url is not null and source_url not in (select url from crawled_articles where url is not null)")
def url_anti_existing(spark, d):
    new = A.comments(spark, d).select(F.col("source_url").alias("url")).where("url is not null").distinct()
    return links.not_stored(new, A.articles(spark, d).select("url"), ["url"])


@query(f"select distinct {REF} as ref, team_name as team, md5(comment) as evidence_hash from scout_comments where comment is not null and {REF} is not null")
def evidence_dedup(spark, d):
    c = A.comments(spark, d)
    return c.select(dedup.visit_ref(F.col("player_id"), F.col("player_candidate_id"), F.col("player_name")).alias("ref"), F.col("team_name").alias("team"), F.md5("comment").alias("evidence_hash")).where("evidence_hash is not null and ref is not null").distinct()


_VISITS = f"(select id, {REF} as ref, coalesce(team_name, '') as team, {S.day('update_at')} as event_date, case when contains(source_url, 'matome.example') then 1 else 0 end as aggregator, created_at from scout_comments where {REF} is not null)"
_KEPT = f"select * from {_VISITS} qualify row_number() over (partition by ref, team, event_date order by aggregator, created_at nulls last, id) = 1"


def _visits(spark, d):
    c = A.comments(spark, d)
    return c.select("id", dedup.visit_ref(F.col("player_id"), F.col("player_candidate_id"), F.col("player_name")).alias("ref"), F.coalesce("team_name", F.lit("")).alias("team"), day(F.col("update_at")).alias("event_date"), F.coalesce(F.col("source_url").contains("matome.example"), F.lit(False)).cast("int").alias("aggregator"), "created_at").where("ref is not null")


@query(f"with k as ({_KEPT}) select id, ref, team, event_date from k where event_date is not null or team = '' or (ref, team) not in (select (ref, team) from k where event_date is not null)")
def visit_dedup_absorb(spark, d):
    return dedup.absorbed_visits(_visits(spark, d)).select("id", "ref", "team", "event_date")


@query(f"""select id, copies from (select id, count(*) over w as copies, row_number() over (partition by {REF}, {S.loose('comment')} order by coalesce({S.strip('scout_name')}, '') = '', contains(coalesce(source_url, ''), 'matome.example'), created_at nulls last, id) as r
from scout_comments where {S.loose('comment')} <> '' and {REF} is not null window w as (partition by {REF}, {S.loose('comment')})) where r = 1""")
def comment_survivor_repair(spark, d):
    ref = dedup.visit_ref(F.col("player_id"), F.col("player_candidate_id"), F.col("player_name"))
    return dedup.comment_survivors(A.comments(spark, d).where(ref.isNotNull()), ref, F.coalesce(F.col("source_url").contains("matome.example"), F.lit(False)))


_FIELDS = ("name_kana", "category", "throws", "bats", "height_cm", "weight_kg", "fastball_max", "description", "school_year")
_STATUS = {"promoted": 3, "pending": 2, "rejected": 1}
_SURVIVOR = f"player_id is null, -{S.case('status', _STATUS, '0')}, -coalesce(source_count, 0), created_at nulls last, id"
_GROUP = f"nullif({S.sub('name', S.SPACE, '')}, ''), coalesce(team, team_name, '')"


@query(f"""with g as (select *, row_number() over (partition by {_GROUP} order by {_SURVIVOR}) as r, count(*) over (partition by {_GROUP}) as members from player_candidates),
f as (select {S.sub('name', S.SPACE, '')} as n, coalesce(team, team_name, '') as t, {', '.join(f"arg_min({x}, r) filter (where {x} is not null) as {x}" for x in _FIELDS)} from g group by 1, 2)
select g.id, g.members, {', '.join(f'coalesce(g.{x}, f.{x}) as {x}' for x in _FIELDS)} from g join f on {S.sub('g.name', S.SPACE, '')} = f.n and coalesce(g.team, g.team_name, '') = f.t where g.r = 1""")
def candidate_merge(spark, d):
    c = A.candidates(spark, d).withColumns({"_n": F.regexp_replace("name", T.SPACE, ""), "_t": F.coalesce("team", "team_name", F.lit(""))})
    order = F.struct(F.col("player_id").isNull(), -F.coalesce(T.looked_up(_STATUS, F.col("status")), F.lit(0)), -F.coalesce("source_count", F.lit(0)), F.col("created_at").isNull(), F.col("created_at"), F.col("id"))
    return dedup.survivor_rows(c, ["_n", "_t"], order, list(_FIELDS)).select("id", "members", *_FIELDS)


@query(f"select {REF} as ref, team_name as team, arg_max(id, (coalesce(source_url, '') <> '', coalesce(epoch_us(published_at), 0), id)) as id from scout_comments where {REF} is not null and team_name is not null group by 1, 2")
def pair_representative(spark, d):
    c = A.comments(spark, d).withColumn("published_at", F.lpad(F.coalesce(F.unix_micros("published_at"), F.lit(0)).cast("string"), 20, "0"))
    return links.representative_per_pair(c, dedup.visit_ref(F.col("player_id"), F.col("player_candidate_id"), F.col("player_name")), F.col("team_name"))


def _seq_numbers(spark, d):
    """(id, source, seq) of articles numbered in the order they were stored."""
    own = A.articles(spark, d).where("id is not null")
    order = own.select("id", "source", "created_at").orderBy(F.asc_nulls_first("created_at"), "id").withColumn("seq", F.monotonically_increasing_id() + 1)
    return checkpointed(order.select("id", "source", "seq"))


def _seq_articles(spark, d):
    """Articles numbered in the order they were stored."""
    return A.articles(spark, d).select("id", "title", "body").join(_seq_numbers(spark, d), "id").select("seq", "title", "body", "source")


@query()
def near_duplicate_articles(spark, d):
    return dedup.similarity_dedup(_seq_numbers(spark, d), 0.8, V.TEST_PRIORITIES, A.articles(spark, d))


@query()
def aggregator_anti_similar(spark, d):
    a = _seq_articles(spark, d)
    told = a.where(F.col("source") == AGGREGATOR).withColumn("seq", F.abs("seq"))
    originals = a.where(F.col("source") != AGGREGATOR).withColumn("seq", -F.abs("seq"))
    again = dedup.similar_pairs(told, originals, 0.7).select(F.col("seq_a").alias("seq")).distinct()
    return told.select("seq", "title").join(again, "seq", "left_anti")


# --- links and rollups ------------------------------------------------------------------------------------


@query("""with s as (select latest_source_url as url, player_id, id as candidate_id, created_at, row_number() over (partition by latest_source_url order by player_id is null, created_at nulls last, id) as r from player_candidates where latest_source_url is not null)
select c.id, s.player_id, s.candidate_id from scout_comments c left join s on s.url = c.source_url and s.r = 1""")
def link_priority(spark, d):
    signals_ = A.comments(spark, d).select("id", F.col("source_url").alias("url"))
    return links.by_article_priority(signals_, A.evidence(spark, d)).select("id", "player_id", "candidate_id")


@query(f"""with k as (select latest_source_url as url, {S.name_key('name')} as k, id from player_candidates where latest_source_url is not null), c as (select id, source_url as url, {S.name_key('player_name')} as k from scout_comments where player_id is null)
select c.id, min(k.id) as candidate_id from c join k using (url, k) where k <> '' group by c.id""")
def comment_candidate_link(spark, d):
    return links.comment_candidates(A.comments(spark, d), A.evidence(spark, d).where("url is not null"))


@query("select l_orderkey as candidate_id, count(*) as source_count, arg_max(l_partkey, (l_shipdate, l_linenumber, l_partkey)) as latest_url, arg_max(l_tax, (l_shipdate, l_linenumber, l_partkey)) as latest_confidence from lineitem group by l_orderkey")
def candidate_rollup(spark, d):
    li = table(spark, d, "lineitem")
    return links.source_rollup(li.select(F.col("l_orderkey").alias("candidate_id"), F.col("l_partkey").alias("url"), F.col("l_tax").alias("confidence"), F.struct("l_shipdate", "l_linenumber").alias("created_at"), F.col("l_partkey").alias("id")))


@query("select s.id, coalesce(s.player_id, c.player_id) as player_id, s.player_candidate_id from scout_comments s left join (select id, player_id from player_candidates where player_id is not null) c on c.id = s.player_candidate_id")
def promote_links(spark, d):
    done = A.candidates(spark, d).where("player_id is not null").select(F.col("id").alias("candidate_id"), "player_id")
    return links.promoted_links(A.comments(spark, d).select("id", "player_id", "player_candidate_id"), done)


@query("select player_name is not null and replace(player_name, ' ', '') in (select replace(name, ' ', '') from players) as registered, count(*) as comments from scout_comments group by 1")
def registered_split(spark, d):
    known = table(spark, d, "players").select(F.replace("name", F.lit(" "), F.lit("")).alias("k")).distinct().withColumn("_r", F.lit(True))
    c = A.comments(spark, d).withColumn("k", F.replace("player_name", F.lit(" "), F.lit("")))
    return c.join(known, "k", "left").groupBy(F.coalesce("_r", F.lit(False)).alias("registered")).agg(F.count("*").alias("comments"))


@query(f"""with k as (select id, nullif({S.sub('name', S.SPACE, '')}, '') as k, 1 as p from players union all select id, nullif({S.sub('name_kana', S.SPACE, '')}, ''), 2 from players),
b as (select k, arg_min(id, (p, id)) as player_id from k where k is not null group by k) select n.name, b.player_id from (select distinct player_name as name from scout_comments where player_name is not null) n left join b on b.k = nullif({S.sub('n.name', S.SPACE, '')}, '')""")
def name_lookup(spark, d):
    return links.name_lookup(A.comments(spark, d).where("player_name is not null").select(F.col("player_name").alias("name")), table(spark, d, "players"))


_ITEMS = f"(select coalesce(source_url, '') as url, {REF} as player, coalesce(team_name, 'all') as team from scout_comments where {REF} is not null)"


@query(f"""with i as {_ITEMS} select distinct url, player, team from i where team <> 'all'
union all select s.url, s.player, t.team from (select distinct url, player from i where team = 'all') s, (select distinct team_key as team from scouts) t where (s.url, s.player, t.team) not in (select (url, player, team) from i where team <> 'all')""")
def all_team_expansion(spark, d):
    c = A.comments(spark, d)
    ref = dedup.visit_ref(F.col("player_id"), F.col("player_candidate_id"), F.col("player_name"))
    team = F.coalesce("team_name", F.lit("all"))
    items = c.select(F.coalesce("source_url", F.lit("")).alias("url"), ref.alias("player"), team.alias("team")).where("player is not null")
    return links.all_team_expansion(items, table(spark, d, "scouts").select(F.col("team_key").alias("team")))


@query(f"""with c as (select id as seq, source_url as url, {REF} as player, team_name as team, scout_name from scout_comments where source_url is not null and {REF} is not null and team_name <> ''),
v as (select distinct url, player, team from c where scout_name is not null) select url, player, team, min(seq) as seq from c where (url, player, team) not in (select (url, player, team) from v) group by 1, 2, 3""")
def derive_visits(spark, d):
    c = A.comments(spark, d)
    ref = dedup.visit_ref(F.col("player_id"), F.col("player_candidate_id"), F.col("player_name"))
    rows = c.select(F.col("id").alias("seq"), F.col("source_url").alias("url"), ref.alias("player"), F.col("team_name").alias("team"), "scout_name").where("url is not null and player is not null and team is not null")
    return links.derived_visits(rows, rows.where("scout_name is not null")).select("url", "player", "team", "seq")


@query("""select id, title, coalesce(o.created, n.created) as created from (select url, id, title, epoch_us(created_at) as created from crawled_articles where url is not null qualify row_number() over (partition by url order by created_at desc nulls last, id) = 1) n
left join (select url, min(epoch_us(created_at)) as created from crawled_articles where url is not null group by url) o using (url)""")
def upsert_by_url(spark, d):
    a = A.articles(spark, d).where("url is not null").select("url", "id", "title", F.unix_micros("created_at").alias("created"))
    old = dedup.first_by(a, ["url"], F.struct(F.col("created").isNull(), "created", "id"))
    new = dedup.first_by(a, ["url"], F.struct(F.col("created").isNull(), -F.col("created"), F.col("id")))
    return links.merged_by_key(old, new, ["url"], ["created"]).select("id", "title", "created")


# --- matching ---------------------------------------------------------------------------------------------


@query()
def entity_match_cascade(spark, d):
    return entity.match_cascade(A.entries(spark, d), A.people(spark, d))


@query()
def entity_suggestions(spark, d):
    e, p = A.entries(spark, d), A.people(spark, d)
    open_ = entity.match_cascade(e, p).where("status = 'unmatched'").select("entry_id")
    return entity.suggestions(e.join(open_, "entry_id"), p)


_BARE = {"e": S.sub("e.name", S.SPACE, ""), "p": S.sub("p.name", S.SPACE, "")}


@query(f"""with m as (select e.entry_id, p.id, e.school, p.team, e.category = p.category as same, contains(e.school, p.team) or contains(p.team, e.school) as near from roster_entries e join players p on {_BARE['e']} = {_BARE['p']}),
n as (select *, count(*) over (partition by entry_id) as n, max(cast(near as int)) over (partition by entry_id) as any_near from m), k as (select * from n where n = 1 or any_near = 0 or near)
select entry_id, count(*) as candidates, min(id) as first_id from k group by entry_id""")
def entity_narrowing_plain(spark, d):
    e = table(spark, d, "roster_entries").select("entry_id", F.regexp_replace("name", T.SPACE, "").alias("k"), "school")
    p = table(spark, d, "players").select(F.regexp_replace("name", T.SPACE, "").alias("k"), "id", "team")
    w = Window.partitionBy("entry_id")
    m = e.join(p, "k").withColumn("near", F.col("school").contains(F.col("team")) | F.col("team").contains(F.col("school")))
    m = m.withColumns({"n": F.count("*").over(w), "any_near": F.max("near").over(w)})
    return m.where((F.col("n") == 1) | ~F.col("any_near") | F.col("near")).groupBy("entry_id").agg(F.count("*").alias("candidates"), F.min("id").alias("first_id"))


# --- topics -----------------------------------------------------------------------------------------------

_SIG = f"""(select s.id, a.title, s.comment as evidence, nullif({S.sub('s.player_name', S.SPACE, '')}, '') as player_key, s.team_name as team, cast(null as int) as year, {S.day('s.published_at')} as day from scout_comments s left join (select url, min(title) as title from crawled_articles group by url) a on a.url = s.source_url)"""
_SIGTEXT = "coalesce(title, '') || chr(10) || coalesce(evidence, '')"
_KIND = f"case when {S.contains_any(_SIGTEXT, V.MEETING_EVENTS)} then 'scout_meeting' when coalesce(player_key, '') <> '' then 'player_watch' when {S.contains_any(_SIGTEXT, V.MEETING_WORDS)} then 'scout_meeting' else 'other' end"
_KEY = "case kind when 'player_watch' then 'player_watch:unknown:' || player_key || ':' || cast(day as varchar) when 'scout_meeting' then 'scout_meeting:' || nullif(team, '') || ':' || cast(day as varchar) || ':unknown' end"
_OTHER = f"'other:' || md5({S.sub('coalesce(nullif(title, chr(32)[2:]), evidence, chr(32)[2:])', S.SPACE, '')})"


def _signals(spark, d):
    titles = A.articles(spark, d).where("url is not null").groupBy("url").agg(F.min("title").alias("title"))
    c = A.comments(spark, d)
    return c.join(titles, F.col("source_url") == F.col("url"), "left").select("id", "title", F.col("comment").alias("evidence"), F.nullif(F.regexp_replace("player_name", T.SPACE, ""), F.lit("")).alias("player_key"), F.col("team_name").alias("team"), F.lit(None).cast("int").alias("year"), day(F.col("published_at")).alias("day"), F.col("source_url").alias("url"), F.col("created_at"), F.coalesce("player_id", "player_candidate_id").alias("player_id"))


@query(f"select id, case when k is null then 'other' else kind end as topic_type, coalesce(k, {_OTHER}) as topic_key from (select *, {_KEY} as k from (select *, {_KIND} as kind from {_SIG}))")
def topic_keys(spark, d):
    return topics.keyed_signals(_signals(spark, d)).select("id", "topic_type", "topic_key")


_EV = "(select event_id, event_type, user_id, cast(ts as date) as day from events)"
_TOPICS = f"(select event_type, user_id, day, min(event_id) as topic_id from {_EV} group by all)"


@query(f"select s.event_id as signal_id, max(t.topic_id) as topic_id from {_EV} s join {_TOPICS} t on s.event_type = t.event_type and s.user_id = t.user_id and abs(date_diff('day', s.day, t.day)) <= 3 group by 1")
def topic_near_match(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "user_id", F.to_date("ts").alias("day"))
    opened = e.groupBy("event_type", "user_id", "day").agg(F.min("event_id").alias("topic_id"))
    new = e.select(F.col("event_id").alias("signal_id"), F.col("event_type").alias("topic_type"), F.col("user_id").alias("player"), "day")
    return topics.near_topics(new, opened.select("topic_id", F.col("event_type").alias("topic_type"), F.col("user_id").alias("player"), F.col("day").alias("event_day"), F.col("topic_id").alias("created_at")))


_MEMBER = "(select event_type || ':' || user_id as topic_key, user_id % 17 as url, cast(floor(value) as int) as team_count, cast(floor(value * 2) as int) as person_count, event_type as team, value > 90 as has_mlb, cast(floor(value / 15) as int) as score, cast(ts as date) as day, event_type = 'error' as meeting, event_id from events)"


@query(f"""select topic_key, max(team_count) as team_count, max(person_count) as person_count, bool_or(has_mlb) as has_mlb, array_to_string(list_sort(list_distinct(list(team))), ',') as teams, array_to_string(list_sort(list_distinct(list(cast(day as varchar)))), ',') as days,
count(distinct url) as sources, max(score) + greatest(0, least(cast(count(distinct url) as int) - 1, 3)) + case when bool_or(meeting) then 2 else 0 end as importance from {_MEMBER} group by topic_key""")
def topic_summary(spark, d):
    e = table(spark, d, "events")
    v = F.col("value")
    m = e.select(F.concat("event_type", F.lit(":"), "user_id").alias("topic_key"), (F.col("user_id") % 17).alias("url"), F.floor(v).cast("int").alias("team_count"), F.floor(v * 2).cast("int").alias("person_count"), F.col("event_type").alias("team"), (v > 90).alias("has_mlb"), F.floor(v / 15).cast("int").alias("score"), F.to_date("ts").alias("day"), (F.col("event_type") == "error").alias("meeting"))
    return topics.summaries(m)


@query()
def topic_sequential(spark, d):
    s = topics.keyed_signals(_signals(spark, d).where("url is not null"))
    return topics.sequential_topics(s.select(F.col("id").alias("signal_id"), "topic_type", "topic_key", "player_id", F.col("player_key").alias("player_name"), "url", "day", F.unix_micros("created_at").alias("created_at")))


# --- rosters ----------------------------------------------------------------------------------------------

_DITTO = "(" + ", ".join(S.quote(x) for x in V.DITTO) + ")"


@query(f"select entry_id, last_value(case when trim(coalesce(affiliation, '')) in {_DITTO} then null else affiliation end ignore nulls) over (partition by table_id order by pos rows between unbounded preceding and current row) as affiliation from roster_entries")
def roster_forward_fill(spark, d):
    return roster.forward_filled(table(spark, d, "roster_entries"), "affiliation").select("entry_id", "affiliation")


_RK = f"{S.sub('name', S.SPACE, '')} || '|' || school"


@query(f"with a as (select distinct {_RK} as k from roster_entries where season = 2025), b as (select distinct {_RK} as k from roster_entries where season = 2026) select coalesce(a.k, b.k) as k, case when a.k is null then 'new' when b.k is null then 'resolved' else 'kept' end as change from a full join b on a.k = b.k")
def state_diff_new_resolved(spark, d):
    r = table(spark, d, "roster_entries").withColumn("k", F.concat(F.regexp_replace("name", T.SPACE, ""), F.lit("|"), "school"))
    return roster.state_changes(r.where("season = 2025"), r.where("season = 2026"), "k")


@query("select id, name, rank_code from players where not coalesce(declared, false) and id not in (select player_id from player_candidates where player_id is not null and status = 'promoted') order by rank_code desc nulls last, name, id limit 10")
def not_submitted_topk(spark, d):
    p = table(spark, d, "players").where("not coalesce(declared, false)")
    done = A.candidates(spark, d).where("player_id is not null and status = 'promoted'").select(F.col("player_id").alias("id"))
    return p.join(done, "id", "left_anti").orderBy(F.desc_nulls_last("rank_code"), "name", "id").limit(10).select("id", "name", "rank_code")


@query("select category, count(*) as entries, count_if(draft_eligible) as eligible, count_if(season = 2026) as this_season, count_if(name_kana is null) as unread from roster_entries group by category")
def conditional_counts(spark, d):
    r = table(spark, d, "roster_entries")
    return r.groupBy("category").agg(F.count("*").alias("entries"), F.count_if("draft_eligible").alias("eligible"), F.count_if(F.col("season") == 2026).alias("this_season"), F.count_if(F.col("name_kana").isNull()).alias("unread"))


_LINE = "'| ' || concat_ws(' | ', name, coalesce(school, '-'), coalesce(received_date, '-')) || ' |'"


@query(f"select category, '| name | school | received |' || chr(10) || '|---|---|---|' || chr(10) || string_agg({_LINE}, chr(10) order by school nulls first, entry_id) as markdown from roster_entries group by category")
def roster_markdown(spark, d):
    return roster.markdown_table(table(spark, d, "roster_entries"), ["name", "school", "received"], ["name", "school", "received_date"], [F.col("school"), F.col("entry_id")], "category")


# --- counts, votes, promotion -----------------------------------------------------------------------------


@query("select coalesce(source, '') as source, count(*) as articles from crawled_articles group by 1")
def source_histogram(spark, d):
    return A.articles(spark, d).groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("articles"))


@query(f"select u as club, count(*) as articles from (select unnest({_keys(chr(99) + 'oalesce(body, chr(32)[2:])')}) as u from crawled_articles) group by u")
def team_counts_exploded(spark, d):
    a = A.articles(spark, d)
    return a.select(F.explode(signals.club_keys_in(F.coalesce("body", F.lit("")), CLUBS, CLUB_ORDER)).alias("club")).groupBy("club").agg(F.count("*").alias("articles"))


_VOTE = {"view": 1, "click": 2, "purchase": 5, "signup": 4, "error": 0}


@query(f"select user_id, sum({S.case('event_type', _VOTE, '1')}) as votes, count(*) as events, rank() over (order by sum({S.case('event_type', _VOTE, '1')}) desc) as place from events group by user_id")
def weighted_vote_ranking(spark, d):
    e = table(spark, d, "events").groupBy("user_id").agg(F.sum(F.coalesce(T.looked_up(_VOTE, F.col("event_type")), F.lit(1))).alias("votes"), F.count("*").alias("events"))
    # places by counts of better votes: the distinct sums are few, the users need not meet in one task
    better = e.groupBy("votes").agg(F.count("*").alias("n")).withColumn("place", F.coalesce(F.sum("n").over(Window.orderBy(F.desc("votes")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1)
    return e.join(better.select("votes", "place"), "votes").select("user_id", "votes", "events", "place")


_STATS = ("height_cm", "weight_kg", "fastball_max")


@query("select * from (select id as ref, unnest(['height_cm', 'weight_kg', 'fastball_max']) as name, unnest([height_cm, weight_kg, fastball_max]) as value from players) where value is not null")
def stats_expand(spark, d):
    p = table(spark, d, "players")
    long = p.select(F.col("id").alias("ref"), F.lit("summer").alias("season"), F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in _STATS])).alias("x")).select("ref", "season", "x.*")
    return promote.stats_rows(long, _STATS).select("ref", "name", "value")


_READY = f"(select *, {S.name_key('name')} as k from player_candidates where status = 'approved' and player_id is null)"
_LINKED = f"(select c.id as candidate_id, min(p.id) as player_id from {_READY} c join (select id, draft_year, {S.name_key('name')} as k from players) p using (k) where c.k <> '' and (c.draft_year is null or p.draft_year is null or c.draft_year = p.draft_year) group by c.id)"
_CODE = f"case {S.category('category')} {' '.join(f'when {S.quote(k)} then {S.quote(v)}' for k, v in promote.CATEGORY_CODES.items())} else {S.category('category')} end"
_HANDS = "case when upper(trim(throws)) = 'R' or contains(throws, '右') then 'R' when upper(trim(throws)) = 'L' or contains(throws, '左') then 'L' end as throw_hand, case when upper(trim(bats)) = 'S' or contains(bats, '両') or contains(bats, 'スイッチ') then 'S' when upper(trim(bats)) = 'R' or contains(bats, '右') then 'R' when upper(trim(bats)) = 'L' or contains(bats, '左') then 'L' end as bat_hand"


@query(f"select id as candidate_id, name, name_kana, coalesce(team, team_name) as team, {_CODE} as category, draft_year, 0 as rank_code, {_positions_sql()} as positions, {_HANDS}, height_cm, weight_kg, fastball_max from {_READY} where k <> '' and id not in (select candidate_id from {_LINKED})")
def promotion_players(spark, d):
    return promote.promotions(A.candidates(spark, d), table(spark, d, "players"))["players"].withColumn("positions", F.array_join("positions", ","))


@query(f"select * from {_LINKED}")
def promotion_links(spark, d):
    return promote.promotions(A.candidates(spark, d), table(spark, d, "players"))["links"]


_RANKED = {"日刊ダイヤモンド": 1, "東雲スポーツ": 2, "スポーツ汐報": 3}


@query(f"with v as (select url as ref, 'title' as field, title as value, source from crawled_articles where url is not null union all select url, 'category', category, source from crawled_articles where url is not null) select ref, field, arg_min(value, ({S.case('source', _RANKED, '1000')}, source, value)) as value, arg_min(source, ({S.case('source', _RANKED, '1000')}, source, value)) as source from v where value is not null group by ref, field")
def field_priority_merge(spark, d):
    a = A.articles(spark, d).where("url is not null")
    long = a.select(F.col("url").alias("ref"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in ("title", "category")])).alias("x"), "source").select("ref", "x.*", "source")
    return promote.merged_by_priority(long, _RANKED)


@query("select event_id, user_id from events where ts > (select max(ts) from events where event_type = 'error')")
def highwater_incremental(spark, d):
    e = table(spark, d, "events")
    mark = e.where("event_type = 'error'").agg(F.max("ts").alias("_mark"))
    return e.join(F.broadcast(mark), F.col("ts") > F.col("_mark")).select("event_id", "user_id")


@query("select id, status, epoch_us(created_at) as created_us from player_candidates where status = 'pending' order by created_at desc nulls last, id limit 50")
def pending_candidates(spark, d):
    c = A.candidates(spark, d).where("status = 'pending'")
    return c.orderBy(F.desc_nulls_last("created_at"), "id").limit(50).select("id", "status", F.unix_micros("created_at").alias("created_us"))


@query("select topic_type, player, signal_id from (select event_type as topic_type, user_id as player, event_id as signal_id, row_number() over (partition by event_type, user_id order by ts desc, event_id desc) as r from events) where r <= 20")
def newest_per_key(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("topic_type"), F.col("user_id").alias("player"), F.col("event_id").alias("signal_id"), "ts")
    return dedup.newest(e, ["topic_type", "player"], [F.desc("ts"), F.desc("signal_id")], 20).select("topic_type", "player", "signal_id")


# --- further queries --------------------------------------------------------------------------------------


def _five_branches(spark, d, art, clock) -> DataFrame:
    ev = A.evidence(spark, d)
    person = ev.where("article_id is not null").groupBy("article_id").agg(F.min_by(F.struct("player_id", "candidate_id"), F.struct(F.col("player_id").isNull(), F.col("created_at"), F.col("id"))).alias("_p"))
    seen = _attention(spark, d).join(art, F.col("id") == F.col("article_id")).drop("id").join(person, "article_id").where("_p.player_id is not null or _p.candidate_id is not null")
    attention = timeline.branch(seen, "attention", player_id=F.col("_p.player_id"), player_candidate_id=F.col("_p.candidate_id"), crawled_article_id=F.col("article_id"), source_url=F.col("url"), title=F.col("title"), published_at=F.col("published_at"), source=F.col("source"), category=F.col("category"), body=F.col("sentence"), score=F.col("score"))
    pages = timeline.branch(table(spark, d, "players"), "site_article", player_id=F.col("id"), title=F.col("name"), published_at=clock(F.col("created_at")), source=F.lit("profile"), category=F.col("category"), created_at=F.col("created_at"))
    items = timeline.news_once(_news(spark, d, art), AGGREGATOR).unionByName(_quoted(spark, d, art, clock)).unionByName(attention).unionByName(pages)
    return items.orderBy(F.desc_nulls_last("published_at"), F.desc_nulls_last("created_at"), "item_type", "player_id", "body")


@query()
def timeline_full(spark, d):
    """All five kinds of items, published at instants told by any notation: candidate and registered-player news,
    comments, attention, profile pages."""
    return _five_branches(spark, d, _dated_articles(spark, d), _instant_text)


_FIVE_SQL = f"""
with art as (select a.id, a.url, a.title, a.source, a.category, {_PUBLISHED} as published_at from crawled_articles a),
n as (select c.player_id, case when c.player_id is null then c.id end as player_candidate_id, c.crawled_article_id, c.latest_source_url as source_url, a.title, a.published_at, a.source, a.category, case when c.player_id is null then 'candidate' else 'player_article' end as item_type, c.name as body, c.latest_confidence as confidence, c.created_at
  from player_candidates c left join art a on a.id = c.crawled_article_id),
r as (select *, row_number() over (partition by player_id, coalesce({_TITLE}, source_url, crawled_article_id) {_OF_NEWS}) as rn from n),
p as (select crawled_article_id as article_id, player_id, id as candidate_id from player_candidates where crawled_article_id is not null qualify row_number() over (partition by crawled_article_id order by player_id is null, created_at nulls first, id) = 1)
select player_id, player_candidate_id, crawled_article_id, source_url, title, published_at, source, category, item_type, body, confidence, cast(null as int) as score, epoch_us(created_at) as created_us from r where rn = 1
union all {_QUOTED_SQL}
union all select p.player_id, p.candidate_id, a.id, a.url, a.title, a.published_at, a.source, a.category, 'attention', w.sentence, null, w.score, null from ({_ROWS}) w join art a using (id) join p on p.article_id = w.id
union all select id, null, null, null, name, {S.instant_text('created_at')}, 'profile', category, 'site_article', null, null, null, epoch_us(created_at) from players"""


@query(_FIVE_SQL)
def timeline_five_branches(spark, d):
    """The same with the clock that the store keeps, which SQL can tell."""
    return _timeline_columns(_five_branches(spark, d, _published_articles(spark, d), _clock_text))


@query("select id, name, case when length(s) >= 2 and not contains(s, ' ') then length(s) else case when contains(s, ' ') then 2 else 1 end end as variations, replace(s, ' ', '') as bare from (select id, name, " + S.strip(S.sub("name", S.SPACE + "+", " ")) + " as s from player_candidates where name is not null)")
def name_variation_counts(spark, d):
    c = A.candidates(spark, d).where("name is not null")
    return c.select("id", "name", F.size(T.name_variations(F.col("name"))).alias("variations"), F.replace(T.spaced_name(F.col("name")), F.lit(" "), F.lit("")).alias("bare"))


@query("select entry_id, coalesce(nullif(regexp_replace(nullif(affiliation, ''), '(?:野球)?連盟$', ''), ''), nullif(affiliation, ''), '—') as federation from roster_entries")
def federation_labels(spark, d):
    return table(spark, d, "roster_entries").select("entry_id", T.federation_label(F.col("affiliation")).alias("federation"))


@query(f"select id, case when lower(trim(team_name)) in ({', '.join(S.quote(v) for v in V.TEST_CLUBS.values())}) then lower(trim(team_name)) end as club from scout_comments")
def comment_club_keys(spark, d):
    return A.comments(spark, d).select("id", T.known_club(F.col("team_name"), tuple(V.TEST_CLUBS.values())).alias("club"))


@query("select id, coalesce(starts_with(url, 'https://') and contains(url, '/article/'), false) as valid from crawled_articles")
def article_urls(spark, d):
    return A.articles(spark, d).select("id", T.article_url(F.col("url"), "https://", "/article/").alias("valid"))


@query(f"select id, case when {_KIND} = 'player_watch' then player_key || 'にスカウトの注目集まる' when {_KIND} = 'scout_meeting' then 'スカウト会議・編成動向まとめ' else coalesce(nullif(title, ''), 'ドラフト関連トピック') end as placeholder from {_SIG}")
def placeholder_titles(spark, d):
    s = _signals(spark, d)
    kind = topics.topic_type(F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("evidence", F.lit(""))), F.col("player_key"))
    return s.select("id", T.placeholder_title(kind, F.col("player_key"), F.lit(0), F.lit(0), F.col("title")).alias("placeholder"))


@query(f"select entry_id, coalesce(category, '') || '|' || {S.name_key('name')} || '|' || {S.school_match_key('school')} as key from roster_entries")
def entry_keys(spark, d):
    return table(spark, d, "roster_entries").select("entry_id", T.entry_key(F.col("category"), F.col("name"), F.col("school")).alias("key"))


@query("select source, id from crawled_articles qualify row_number() over (partition by source order by created_at desc nulls last, id) <= 20")
def per_source_limit(spark, d):
    return dedup.newest(A.articles(spark, d), ["source"], [F.desc_nulls_last("created_at"), F.asc("id")], 20).select("source", "id")


@query("select distinct player_name, player_team, team_name, scout_name, comment from scout_comments")
def exact_row_distinct(spark, d):
    return A.comments(spark, d).select("player_name", "player_team", "team_name", "scout_name", "comment").distinct()


_CV = f"(select id, source_url as url, {REF} as player, {S.day('published_at')} as published, update_at is not null as dated from scout_comments)"


@query(f"with c as {_CV} select c.id, coalesce(v.event_date, c.published) as event_date from c left join (select url, player, arg_min(published, id) as event_date from c where dated and url is not null and player is not null and published is not null group by 1, 2) v on v.url = c.url and v.player = c.player")
def event_date_resolution(spark, d):
    c = A.comments(spark, d)
    rows = c.select("id", F.col("source_url").alias("url"), dedup.visit_ref(F.col("player_id"), F.col("player_candidate_id"), F.col("player_name")).alias("player"), day(F.col("published_at")).alias("published"), F.col("update_at").isNotNull().alias("dated"))
    visits = rows.where("dated").select("url", "player", F.col("published").alias("event_date"), F.col("id").alias("seq"))
    return links.event_dates(rows.drop("dated"), visits).select("id", "event_date")


@query("select distinct crawled_article_id as article, id as candidate from player_candidates where crawled_article_id is not null and (crawled_article_id, id) not in (select crawled_article_id, id from player_candidates where crawled_article_id is not null and status = 'promoted')")
def bridge_missing_pairs(spark, d):
    c = A.candidates(spark, d).select(F.col("crawled_article_id").alias("article"), F.col("id").alias("candidate"), "status")
    return links.missing_pairs(c, c.where("status = 'promoted'"), "article", "candidate")


@query("select id, coalesce(case when id in (select player_id from player_candidates where player_id is not null and status = 'promoted') then true end, declared, false) as declared from players")
def declared_update(spark, d):
    done = A.candidates(spark, d).where("status = 'promoted'").select("player_id")
    return links.declared(table(spark, d, "players").select("id", "declared"), done)


@query("select s.id, case when s.player_id is null and s.player_candidate_id is null then c.cid else s.player_candidate_id end as player_candidate_id from scout_comments s left join (select latest_source_url as url, min(id) as cid from player_candidates where latest_source_url is not null group by 1) c on c.url = s.source_url")
def comment_backfill_links(spark, d):
    return links.backfilled(A.comments(spark, d).select("id", "player_id", "player_candidate_id", "source_url"), A.evidence(spark, d)).select("id", "player_candidate_id")


@query("select id, case when status = 'approved' and source_count > 1 then 'promoted' else status end as status, coalesce(status = 'approved' and source_count > 1, false) as accepted from player_candidates where name is not null")
def lifecycle_transitions(spark, d):
    c = A.candidates(spark, d).where("name is not null")
    wanted = c.where("source_count > 1").select("id", F.lit("promoted").alias("status"))
    return promote.stepped(c.select("id", "status"), wanted, {"pending": ("approved", "rejected"), "approved": ("promoted",)})


@query(f"with p as (select {_RK} as k, min(entry_id) as first_seen_at from roster_entries where season = 2025 group by 1) select e.entry_id, coalesce(p.first_seen_at, e.entry_id + 100000) as first_seen_at from (select *, {_RK} as k from roster_entries where season = 2026) e left join p using (k)")
def first_seen_carry_over(spark, d):
    r = table(spark, d, "roster_entries").withColumn("k", F.concat(F.regexp_replace("name", T.SPACE, ""), F.lit("|"), "school"))
    before = r.where("season = 2025").groupBy("k").agg(F.min("entry_id").alias("first_seen_at"))
    return roster.carried_over(before, r.where("season = 2026"), "k", F.col("entry_id") + 100_000).select("entry_id", "first_seen_at")


@query("select category, count(*) as articles, count(distinct source) as sources, min(id) as first_id from crawled_articles group by category")
def news_category_counts(spark, d):
    return A.articles(spark, d).groupBy("category").agg(F.count("*").alias("articles"), F.countDistinct("source").alias("sources"), F.min("id").alias("first_id"))


@query(f"select team_name as team, {S.day('published_at')} as day, count(*) as comments, count(distinct {REF}) as players from scout_comments group by 1, 2")
def team_visit_summary(spark, d):
    ref = dedup.visit_ref(F.col("player_id"), F.col("player_candidate_id"), F.col("player_name"))
    return A.comments(spark, d).groupBy(F.col("team_name").alias("team"), day(F.col("published_at")).alias("day")).agg(F.count("*").alias("comments"), F.countDistinct(ref).alias("players"))


@query("select id, title from crawled_articles order by created_at desc nulls last, id limit 20 offset 20")
def news_page(spark, d):
    return A.articles(spark, d).orderBy(F.desc_nulls_last("created_at"), "id").offset(20).limit(20).select("id", "title")


@query("select id, player_name, team_name from scout_comments where player_name is not null and trim(player_name) <> '' and player_name not in ('不明', 'unknown')")
def unknown_name_drop(spark, d):
    n = F.col("player_name")
    return A.comments(spark, d).where(n.isNotNull() & (F.trim(n) != "") & ~n.isin("不明", "unknown")).select("id", "player_name", "team_name")

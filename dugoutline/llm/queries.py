"""Queries of the training-data operators and the SQL that some can be checked by."""

from __future__ import annotations

from pyspark.sql import functions as F

from dugoutline.llm import formatting_copies, leakage, linkage, lookalikes, near_duplicates, packing, people, quality, survivors
from dugoutline.session import table


def p1_found(spark, d):
    return people.person_pairs(table(spark, d, "player_candidates"))


def p2_found(spark, d):
    return linkage.matches(table(spark, d, "roster_entries"), table(spark, d, "player_candidates")).select("candidate_id", "entry_id")


def p1_people(spark, d):
    return people.people_of(table(spark, d, "player_candidates"))


def p2_matches(spark, d):
    return linkage.matches(table(spark, d, "roster_entries"), table(spark, d, "player_candidates"))


def p3_plain_comments(spark, d):
    return lookalikes.lookalike_rows(table(spark, d, "scout_comments"), "id", "comment").select("record_id", "plain")


def p5_survivors(spark, d):
    best = survivors.survivors(table(spark, d, "player_candidates"))
    return best.select("name", "team", "keep_id", "copies", *[F.col(f"{f}.value").alias(f) for f in survivors.FIELDS])


def p9_coverage(spark, d):
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p3_found(spark, d):
    comments = lookalikes.lookalike_rows(table(spark, d, "scout_comments"), "id", "comment")
    names = lookalikes.lookalike_rows(table(spark, d, "player_candidates"), "id", "name")
    return comments.select(F.lit("comment").alias("record_kind"), "record_id").unionByName(names.select(F.lit("candidate").alias("record_kind"), "record_id"))


def p3_name_skeletons(spark, d):
    return lookalikes.skeleton_groups(table(spark, d, "player_candidates"), "name").where("spellings > 1")


def p4_found(spark, d):
    return near_duplicates.near_duplicate_pairs(table(spark, d, "crawled_articles"))


def p4_stories(spark, d):
    return near_duplicates.story_links(table(spark, d, "crawled_articles"))


def p5_found(spark, d):
    return survivors.merged_fields(table(spark, d, "player_candidates"))


def p7_found(spark, d):
    return formatting_copies.formatting_pairs(table(spark, d, "scout_comments"))


def p7_copies(spark, d):
    return formatting_copies.distinct_comments(table(spark, d, "scout_comments")).select("first_id", "copies")


def p8_containers(spark, d):
    return packing.containers(table(spark, d, "documents"), packing.vocabulary())


def p9_found(spark, d):
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p10_found(spark, d):
    return quality.text_kinds(table(spark, d, "documents"), table(spark, d, "doc_labels")).where("not is_prose").select("doc_id")


def p10_statistics(spark, d):
    return quality.ratios(quality.text_statistics(table(spark, d, "documents"))).select("doc_id", "words", "lines", *quality.FEATURES, *quality.RULES)


QUERIES = {f.__name__: f for f in (p1_found, p1_people, p2_found, p2_matches, p3_found, p3_name_skeletons, p3_plain_comments, p4_found, p4_stories, p5_found, p5_survivors, p7_found, p7_copies, p8_containers, p9_found, p9_coverage, p10_found, p10_statistics)}

_ORDER = "(case when trim(player_id) <> '' then 0 else 1 end), (case status when 'promoted' then 1 when 'approved' then 2 when 'pending' then 3 when 'rejected' then 4 else 5 end), -coalesce(source_count, 0), created_at asc nulls last, id"
_BLANK = {f: f"nullif(regexp_replace(cast({f} as varchar), '[\\s\\x{{3000}}]+', '', 'g'), '')" for f in survivors.FIELDS} | {"positions": "case when len(positions) > 0 then 'x' end"}
ORACLE = {
    "p5_found": f"""
with g as (select *, row_number() over (partition by name, team order by {_ORDER}) as r, count(*) over (partition by name, team) as n
           from player_candidates where name is not null and team is not null),
k as (select name, team, id as keep_id from g where r = 1 and n > 1),
f as ({" union all ".join(f"select name, team, '{f}' as field_name, arg_min(id, r) as from_id, min(r) as r from g where n > 1 and {_BLANK[f]} is not null group by name, team" for f in survivors.FIELDS)})
select keep_id, 'id' as field_name, keep_id as from_id from k
union all select k.keep_id, f.field_name, f.from_id from f join k using (name, team) where f.r > 1""",
}

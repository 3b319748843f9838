"""ANSI SQL giving the same answers as the registered queries, for DuckDB.

Fitted models have no SQL form: their queries run the whole fit and return what SQL can check of it,
sizes, scaled features and whether invariants hold.
"""

from __future__ import annotations

from opinara.sources.star import ALL_COLUMNS, RAW_COLUMNS, REVIEW_COLUMNS

# Spark's English stop words.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()
# Domain stop words.
DOMAIN_STOP_WORDS = "hotel room rooms stay staff place night nights".split()


def _literals(words: list[str]) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


_JOINED = """
with joined as (
  select l.*, o.o_orderdate, cn.n_name as cn_name, s.s_suppkey, s.s_name, s.s_nationkey,
         sn.n_regionkey as sn_regionkey, p.p_name, p.p_type, d.text as doc_text
  from lineitem l
  left join orders o on l.l_orderkey = o.o_orderkey
  left join customer c on o.o_custkey = c.c_custkey
  left join nation cn on c.c_nationkey = cn.n_nationkey
  left join supplier s on l.l_suppkey = s.s_suppkey
  left join nation sn on s.s_nationkey = sn.n_nationkey
  left join part p on l.l_partkey = p.p_partkey
  left join documents d
    on d.doc_id = (l.l_orderkey * 8 + l.l_linenumber) % (select count(*) from documents)
)"""
_REVIEW_SELECT = ", ".join(f"{sql} as {name}" for name, (sql, _) in REVIEW_COLUMNS.items())
_WORD_SELECT = """
  case when neg_text = 'No Negative' then 0 else length(neg_text) - length(replace(neg_text, ' ', '')) + 1 end as neg_words,
  case when pos_text = 'No Positive' then 0 else length(pos_text) - length(replace(pos_text, ' ', '')) + 1 end as pos_words"""
_REVIEWS = f"""{_JOINED},
texts as (select l_orderkey, l_linenumber, {_REVIEW_SELECT} from joined),
reviews as (select *, {_WORD_SELECT} from texts)"""

ORACLES: dict[str, str] = {}


def check(name: str, sql: str, source: str = _REVIEWS) -> None:
    ORACLES[name] = f"{source}{sql}"


# --- loading and first look -------------------------------------------------

_RAW = _REVIEWS + ", raw as (select {} from reviews)".format(
    ", ".join(f"{sql} as {name}" for name, sql in RAW_COLUMNS.items())
)


def _finite(name: str) -> str:
    number = f"try_cast(nullif({name}, 'NA') as double)"
    return f"case when isfinite({number}) then {number} end"


def _judged(na_stays: bool) -> str:
    def missing(name: str) -> str:
        na = "" if na_stays else f" or {name} = 'NA'"
        return f"when {name} is null or {name} = ''{na} then 'missing {name}'"

    def unusable(name: str) -> str:
        return f"when {name}_d is null then 'unusable {name}'"

    texts = " ".join(missing(n) for n in ("entity", "event_date", "neg_text", "pos_text"))
    numbers = " ".join(unusable(n) for n in ("lat", "lng", "prior_score"))
    return f"""{_RAW},
typed as (
  select *, {_finite("lat")} as lat_d, {_finite("lng")} as lng_d,
         {_finite("prior_score")} as prior_score_d, {_finite("score")} as score_d,
         try_cast(nullif(total_reviews, 'NA') as int) as total_reviews_i
  from raw
),
judged as (select *, case {texts} {numbers} else 'kept' end as outcome from typed)"""


check(
    "clean_reviews",
    """
select nullif(entity, 'NA') as entity, nullif(event_date, 'NA') as event_date, lat_d as lat, lng_d as lng,
       prior_score_d as prior_score, total_reviews_i as total_reviews, score_d as score,
       nullif(segment, 'NA') as segment, tags, length(neg_text) as neg_chars, length(pos_text) as pos_chars,
       md5(neg_text) as neg_md5, md5(pos_text) as pos_md5
from judged where outcome = 'kept'""",
    _judged(na_stays=False),
)
check(
    "cleaning_report",
    " select outcome, count(*) as n from judged group by outcome",
    _judged(na_stays=False),
)
check(
    "cleaning_report_na_stays",
    " select outcome, count(*) as n from judged group by outcome",
    _judged(na_stays=True),
)
check(
    "dataset_overview",
    """
select count(*) as n_reviews, avg(prior_score) as avg_prior, count(distinct entity) as n_entities
from reviews""",
)


def _preview(columns: list[str]) -> str:
    order = "l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity"
    return f""",
first as (select l_orderkey, l_linenumber from (select * from lineitem order by {order} limit 200))
select {", ".join(columns)} from reviews semi join first using (l_orderkey, l_linenumber)"""


check("review_preview", _preview(["entity", "score", "segment", "pos_text", "neg_text"]))
check("review_preview_all_columns", _preview(list(ALL_COLUMNS)))

# --- segments ---------------------------------------------------------------

_SEVERITY = (
    _REVIEWS
    + """,
severity as (
  select trim(segment) as segment, round(avg(score), 3) as mean_score, count(*) as n,
         round(stddev_samp(score), 3) as std_score, min(score) as min_score, max(score) as max_score
  from reviews group by trim(segment) having count(*) > 100
),
ranked as (
  select *, row_number() over (order by mean_score desc nulls last, segment) as from_top,
         row_number() over (order by mean_score asc nulls last, segment) as from_bottom
  from severity
)"""
)
check("segment_severity", " select * from severity", _SEVERITY)
check(
    "segment_summary",
    """
select count(*) as n_segments, round(avg(std_score), 6) as mean_std,
       round(max(mean_score) - min(mean_score), 3) as mean_range
from severity""",
    _SEVERITY,
)
check(
    "segment_extremes",
    """
select 'generous' as side, cast(from_top as int) as rank, segment, mean_score, n from ranked where from_top <= 5
union all
select 'critical', cast(from_bottom as int), segment, mean_score, n from ranked where from_bottom <= 5""",
    _SEVERITY,
)
check(
    "segment_chart",
    """
select 'generous' as side, cast(from_top as int) as rank, segment || ' (' || n || ')' as label, mean_score
from ranked where from_top <= 15
union all
select 'critical', cast(from_bottom as int), segment || ' (' || n || ')', mean_score
from ranked where from_bottom <= 15""",
    _SEVERITY,
)

# --- keywords ---------------------------------------------------------------

_HIT = r"regexp_matches(neg_text, '(?i)\b(widget|ring)\b')"
_FOUND = r"regexp_extract(neg_text, '(?i)\b(widget|ring)\b', 1)"
_IMPACT = (
    _REVIEWS
    + f""",
impact as (
  select {_HIT} as has_keyword, round(avg(score), 3) as mean_score, count(*) as n,
         round(stddev_samp(score), 3) as std_score,
         round(1.96e0 * (stddev_samp(score) / sqrt(count(*))), 3) as ci95
  from reviews group by {_HIT}
)"""
)
check("keyword_impact", " select * from impact", _IMPACT)
check(
    "keyword_frequency",
    f" select lower({_FOUND}) as keyword, count(*) as n from reviews where {_HIT} group by 1",
)
_MANY = r"'(?i)\b(anvil|bolt|gear|gizmo|plate|ring|rod|widget|small|red|blue|hot)\b'"
check(
    "keyword_top10",
    f"""
select regexp_extract(neg_text, {_MANY}, 1) as keyword, count(*) as n
from reviews where regexp_matches(neg_text, {_MANY}) group by 1 order by n desc, keyword limit 10""",
)


def _hash(*keys: str) -> str:
    return f"cast('0x' || substring(md5(concat_ws('|', {', '.join(keys)})), 1, 8) as bigint)"


check(
    "keyword_samples",
    f"""
select l_orderkey, l_linenumber, entity, score, neg_text, {"lower(" + _FOUND + ")"} as keyword
from reviews where {_HIT}
order by {_hash("l_orderkey", "l_linenumber", "entity", "score", "neg_text", "'42'")}, l_orderkey, l_linenumber limit 5""",
)
check(
    "keyword_verdict",
    """,
sides as (
  select max(n) filter (has_keyword) as n_hit, max(n) filter (not has_keyword) as n_other,
         max(mean_score) filter (has_keyword) as mean_hit, max(mean_score) filter (not has_keyword) as mean_other,
         max(ci95) filter (has_keyword) as ci_hit, max(ci95) filter (not has_keyword) as ci_other,
         round(max(mean_score) filter (has_keyword) - max(mean_score) filter (not has_keyword), 3) as diff,
         round(max(ci95) filter (has_keyword) + max(ci95) filter (not has_keyword), 3) as threshold
  from impact
)
select *, case when diff < -coalesce(threshold, 0.3e0) then 'strong' when diff < 0 then 'mild' else 'none' end as verdict
from sides where diff is not null""",
    _IMPACT,
)

check(
    "keyword_summary",
    f""",
per_keyword as (
  select {_HIT} as has_keyword, case when {_HIT} then lower({_FOUND}) end as keyword, count(*) as n_keyword from reviews group by 1, 2
),
sides as (
  select max(mean_score) filter (has_keyword) as mean_hit, max(mean_score) filter (not has_keyword) as mean_other,
         round(max(ci95) filter (has_keyword) + max(ci95) filter (not has_keyword), 3) as threshold
  from impact
),
judged as (select *, round(mean_hit - mean_other, 3) as diff from sides)
select p.has_keyword, p.keyword, p.n_keyword, i.n, i.mean_score, i.std_score, i.ci95, mean_hit, mean_other, diff, threshold,
       case when diff is null then null when diff < -coalesce(threshold, 0.3e0) then 'strong' when diff < 0 then 'mild' else 'none' end as verdict
from per_keyword p join impact i on p.has_keyword is not distinct from i.has_keyword cross join judged""",
    _IMPACT,
)

# --- travellers, lengths ----------------------------------------------------

_TRAVELLER = """case when lower(tags) like '%solo traveler%' then 'Solo' when lower(tags) like '%family%' then 'Family'
  when lower(tags) like '%group%' then 'Group' when lower(tags) like '%couple%' then 'Couple' else 'Other' end"""
_SATISFACTION = (
    _REVIEWS
    + f""",
satisfaction as (
  select {_TRAVELLER} as traveller, round(avg(score), 3) as mean_score, count(*) as n,
         round(stddev_samp(score), 3) as std_score,
         round(1.96e0 * (stddev_samp(score) / sqrt(count(*))), 3) as ci95
  from reviews group by 1 having count(*) > 50
)"""
)
check("traveller_satisfaction", " select * from satisfaction", _SATISFACTION)
check(
    "traveller_best_worst",
    """
select (select traveller from satisfaction order by mean_score desc, traveller limit 1) as best,
       max(mean_score) as best_score,
       (select traveller from satisfaction order by mean_score asc, traveller limit 1) as worst,
       min(mean_score) as worst_score
from satisfaction""",
    _SATISFACTION,
)
_LENGTHS = (
    _REVIEWS
    + """,
buckets as (
  select case when score < 5 then 0 when score < 7.5 then 1 when score < 9 then 2 else 3 end as bucket_id,
         avg(neg_words) as neg, avg(pos_words) as pos,
         count(case when neg_words > 0 then 1 end) / count(*) * 100 as has_neg,
         count(case when pos_words > 0 then 1 end) / count(*) * 100 as has_pos, count(*) as n
  from reviews group by 1
),
lengths as (
  select bucket_id,
         case bucket_id when 0 then '< 5.0 (angry)' when 1 then '5.0-7.5 (disappointed)'
           when 2 then '7.5-9.0 (satisfied)' else '>= 9.0 (happy)' end as bucket,
         round(neg, 2) as avg_neg_words, round(pos, 2) as avg_pos_words, round(neg - pos, 2) as delta,
         round(case when pos >= 3 then neg / pos end, 3) as neg_pos_ratio,
         round(has_neg, 2) as pct_has_neg, round(has_pos, 2) as pct_has_pos, n
  from buckets
)"""
)
check("length_asymmetry", " select * from lengths", _LENGTHS)
check(
    "length_long",
    """
select bucket_id, bucket, 'positive' as side, avg_pos_words as mean_words from lengths
union all select bucket_id, bucket, 'negative', avg_neg_words from lengths""",
    _LENGTHS,
)
check(
    "length_verdict",
    """
select (select bucket from lengths order by delta desc, bucket_id limit 1) as most_negative, max(delta) as max_delta,
       (select bucket from lengths order by delta asc, bucket_id limit 1) as most_positive, min(delta) as min_delta,
       case when max(delta) > 10 then 'venting' else 'balanced' end as verdict
from lengths""",
    _LENGTHS,
)

# --- entities ---------------------------------------------------------------


def _reliability(min_count: int, tail: str = "") -> str:
    return f"""
select entity, round(avg(prior_score), 2) as avg_prior, round(avg(score), 2) as mean_score,
       round(stddev_samp(score), 2) as std_score, count(*) as n,
       round(stddev_samp(score) / avg(score), 4) as cv
from reviews group by entity having count(*) >= {min_count} {tail}"""


check("score_reliability", _reliability(100))
check("score_reliability_top", _reliability(500, "order by std_score desc, entity limit 10"))


def _risk(min_prior: float, min_pct: float, tail: str = "") -> str:
    return f""",
entities as (
  select entity, avg(prior_score) as avg_prior, avg(score) as mean_score, count(*) as n,
         count(case when score <= 4 then 1 end) as disaster_count, quantile_disc(score, 0.05) as p05
  from reviews group by entity
),
rated as (select *, round(disaster_count / n * 100, 2) as disaster_pct from entities)
select *, round(disaster_pct * ln(1 + n), 2) as risk_index from rated
where n >= 50 and avg_prior >= {min_prior} and disaster_pct >= {min_pct} {tail}"""


check("hidden_risk", _risk(8.0, 5.0))
check("hidden_risk_top3", _risk(7.5, 15.0, "order by risk_index desc, disaster_pct desc, entity limit 3"))

_GAPS = (
    _REVIEWS
    + """,
gaps as (
  select case when prior_score < 7.5 then 0 when prior_score < 8.5 then 1 when prior_score < 9.2 then 2 else 3 end
           as bucket_id,
         round(avg(score - prior_score), 3) as avg_gap,
         round(count(case when score - prior_score < 0 then 1 end) / count(*) * 100, 2) as pct_below,
         round(coalesce(avg(case when score - prior_score < 0 then score - prior_score end), 0), 3) as mean_shortfall,
         count(*) as n
  from reviews group by 1
),
bands as (
  select bucket_id,
         case bucket_id when 0 then 'economy (< 7.5)' when 1 then 'standard (7.5-8.5)'
           when 2 then 'premium (8.5-9.2)' else 'luxury (>= 9.2)' end as bucket,
         avg_gap, pct_below, mean_shortfall, n
  from gaps
)"""
)
check("expectation_gap", " select * from bands", _GAPS)
check(
    "gap_verdict",
    """,
shown as (select * from bands where n >= 100),
ends as (
  select (select bucket from shown order by mean_shortfall, bucket_id limit 1) as harshest,
         abs(min(mean_shortfall)) as harshest_shortfall,
         (select bucket from shown order by mean_shortfall desc, bucket_id limit 1) as mildest,
         abs(max(mean_shortfall)) as mildest_shortfall
  from shown
)
select *, round(harshest_shortfall - mildest_shortfall, 3) as diff,
       case when round(harshest_shortfall - mildest_shortfall, 3) >= 0.3 then 'more intense' else 'similar' end as verdict
from ends where harshest is not null""",
    _GAPS,
)
_POINTS = (
    _REVIEWS
    + """,
points as (
  select entity, lat, lng, avg(score) as mean_score, count(*) as n
  from reviews group by entity, lat, lng having count(*) >= 50
)"""
)
check("map_points", " select * from points", _POINTS)
check("map_points_thinned", f""" select * from points where {_hash("entity", "'42'")} < 2147483648""", _POINTS)
check(
    "map_summary",
    """
select count(*) as n_entities, round(avg(mean_score), 6) as mean_of_means,
       cast(coalesce(sum(n), 0) as bigint) as n_reviews
from points""",
    _POINTS,
)
check(
    "map_top5",
    " select entity, mean_score, n from points order by mean_score desc, n desc, entity limit 5",
    _POINTS,
)

# --- profiling --------------------------------------------------------------


def _theme(pattern: str) -> str:
    return f"count(case when regexp_matches(neg_text, '{pattern}') then 1 end) / count(*) * 100"


_FEATURES = (
    _REVIEWS
    + f""",
features as (
  select entity, lat, lng, avg(score) as mean_score, count(score) as n_scores,
         count(case when score >= 9 then 1 end) / count(*) * 100 as pct_excellent,
         count(case when score < 6 then 1 end) / count(*) * 100 as pct_negative,
         avg(length(pos_text)) / (avg(length(neg_text)) + 1) as pos_neg_ratio,
         avg(length(pos_text) + length(neg_text)) as mean_length,
         count(distinct segment) as n_segments,
         {_theme("(?i)widget|ring")} as pct_construction,
         {_theme("(?i)plate|rod")} as pct_cleanliness,
         {_theme("(?i)gizmo")} as pct_staff
  from reviews group by entity, lat, lng
)"""
)
check("entity_features", " select * from features", _FEATURES)
_NAMED = """,
stats as (
  select cast(floor(lng / 20) as int) as cluster, count(*) as n_entities, avg(mean_score) as mean_score,
         avg(n_scores) as mean_reviews, avg(pct_excellent) as mean_excellent,
         (avg(pct_construction) + avg(pct_cleanliness) + avg(pct_staff)) / 3 as mean_problems
  from features group by 1
),
based as (
  select *, case when mean_score >= 8.5 and mean_reviews > 500 then 'Premium Hotels'
                 when mean_score >= 8 and mean_reviews < 200 then 'Hidden Gems'
                 when mean_score < 7 or mean_problems > 15 then 'Budget/Problems'
                 when mean_reviews > 800 then 'Popular Mixed' else 'Cluster ' || cluster end as base
  from stats
)
select cluster,
       case when row_number() over (partition by base order by cluster) = 1 then base
            else base || ' #' || cluster end as name,
       case when mean_score >= 8.5 then 'excellent' when mean_score >= 7.5 then 'good' else 'to improve' end as tier,
       n_entities, round(mean_score, 6) as mean_score, round(mean_reviews, 6) as mean_reviews,
       round(mean_excellent, 6) as mean_excellent, round(mean_problems, 6) as mean_problems
from based"""
check("region_profile_names", _NAMED, _FEATURES)
check(
    "region_profile_examples",
    _NAMED.replace("select cluster,\n       case when row_number()", ", named as (select cluster,\n       case when row_number()")
    + """
),
ranked as (
  select cast(floor(lng / 20) as int) as cluster, entity, mean_score, n_scores,
         cast(row_number() over (partition by floor(lng / 20)
              order by mean_score desc nulls last, n_scores desc, entity) as int) as rank
  from features
)
select named.cluster, name, tier, entity, ranked.mean_score, n_scores, rank
from ranked join named on ranked.cluster = named.cluster where rank <= 3""",
    _FEATURES,
)

_COMPLETE = """,
complete as (
  select * from features
  where mean_score is not null and n_scores is not null and pct_excellent is not null and pct_negative is not null
    and pos_neg_ratio is not null and mean_length is not null and n_segments is not null
)"""
check(
    "cluster_assign",
    _COMPLETE
    + """
select entity, lat, lng, true as grouped, true as at_nearest, true as center_is_mean,
       round((mean_score - avg(mean_score) over ()) / stddev_samp(mean_score) over (), 6) + 0e0 as z_first
from complete""",
    _FEATURES,
)
check(
    "cluster_stats",
    _COMPLETE
    + """
select cast(4 as bigint) as n_clusters, cast(count(*) as bigint) as n_entities, round(avg(mean_score), 4) as mean_score,
       round(avg(n_scores), 4) as mean_reviews, round(avg(pct_excellent), 4) as mean_excellent,
       round((avg(pct_construction) + avg(pct_cleanliness) + avg(pct_staff)) / 3, 4) as mean_problems
from complete""",
    _FEATURES,
)
check(
    "cluster_quality",
    _COMPLETE
    + """
select cast(k as int) as k, true as in_range, true as best_is_highest, true as cost_falls
from range(2, 7) as t(k) where k <= (select count(*) from complete)""",
    _FEATURES,
)
check(
    "cluster_names",
    _COMPLETE
    + """
select cast(4 as bigint) as n_clusters, cast(4 as bigint) as n_names, cast(0 as bigint) as n_wrong,
       cast(count(*) as bigint) as n_entities
from complete""",
    _FEATURES,
)
check(
    "cluster_examples",
    _COMPLETE
    + """
select cast(4 as bigint) as n_clusters, max(mean_score) as best_score, 1 as first_rank, cast(4 as bigint) as n_first
from complete""",
    _FEATURES,
)

# --- sentiment ----------------------------------------------------------------


def _corpus(review: str) -> str:
    return (
        _REVIEWS
        + f""",
corpus as (
  select {review} as review, case when score >= 7.5 then 1e0 else 0e0 end as label from reviews
)
select label, count(*) as n, cast(sum(length(review)) as bigint) as n_chars
from corpus where length(review) > 20 group by label"""
    )


check("sentiment_corpus", "", _corpus("concat_ws(' ', neg_text, pos_text)"))
check(
    "sentiment_corpus_without_sentinels",
    "",
    _corpus(
        "concat_ws(' ', case when neg_text not in ('No Negative', 'No Positive') then neg_text end,"
        " case when pos_text not in ('No Negative', 'No Positive') then pos_text end)"
    ),
)
_LABELLED = f"""
with labelled as (
  select d.doc_id, d.text as review, case when quality = 1 then 1e0 else 0e0 end as label,
         {_hash("d.doc_id", "'sample-42'")} as sample_hash,
         case when {_hash("d.doc_id", "'split-42'")} < 858993459 then 'test' else 'train' end as split
  from documents d join labels l on d.doc_id = l.doc_id
  where length(d.text) > 20
)"""
check(
    "sentiment_split",
    " select doc_id, label, split from labelled where sample_hash < 1288490189",
    _LABELLED,
)
check(
    "sentiment_balance",
    """
select count(*) as n_train, count(*) filter (label = 0) as n_negative, count(*) filter (label = 1) as n_positive,
       count(*) filter (label = 1) / greatest(count(*) filter (label = 0), 1) as balance
from labelled where split = 'train'""",
    _LABELLED,
)


check(
    "sentiment_metrics",
    """
select count(*) as n_sampled, count(*) filter (split = 'train') as n_train, count(*) filter (split = 'test') as n_test,
       count(*) filter (split = 'train' and label = 0) as train_negative,
       count(*) filter (split = 'train' and label = 1) as train_positive,
       count(*) filter (split = 'test') as n_predicted, true as accuracy_is_share_of_hits,
       true as above_larger_class, true as slope_is_small
from labelled""",
    _LABELLED,
)
check("sentiment_predictions", " select doc_id, label, true as is_favoured from labelled where split = 'test'", _LABELLED)
check(
    "sentiment_examples",
    f"""
select review as text, case when label = 1 then 'Pos' else 'Neg' end as label, true as named, true as likelier
from labelled d where split = 'test' order by {_hash("d.doc_id", "'examples-42'")}, doc_id limit 10""",
    _LABELLED,
)


def _vocabulary(min_df: int, size: int) -> str:
    return f""",
counted as (
  select term, count(*) as term_count, count(distinct doc_id) as doc_freq from terms group by term
),
kept as (
  select * from counted where doc_freq >= {min_df} order by term_count desc, term limit {size}
)
select term, term_count, doc_freq, cast(row_number() over (order by term_count desc, term) - 1 as int) as idx
from kept"""


check(
    "sentiment_vocab",
    rf""",
words as (
  select doc_id, unnest(string_split_regex(regexp_replace(lower(review), '\s+$', ''), '\s')) as term
  from labelled where split = 'train'
),
terms as (select * from words where term not in ({_literals(ENGLISH_STOP_WORDS)}))"""
    + _vocabulary(5, 800),
    _LABELLED,
)

# --- topics -------------------------------------------------------------------

check(
    "topic_corpus",
    f"""
select {_TRAVELLER} as traveller, count(*) as n_texts, cast(sum(length(lower(neg_text))) as bigint) as n_chars
from reviews where neg_text <> 'No Negative' and length(neg_text) > 30 group by 1""",
)
check(
    "topic_vocab",
    rf"""
with words as (
  select doc_id, unnest(regexp_extract_all(lower(text), '\p{{L}}{{3,}}')) as term
  from documents where text <> 'No Negative' and length(text) > 30
),
terms as (select * from words where term not in ({_literals(ENGLISH_STOP_WORDS + DOMAIN_STOP_WORDS)}))"""
    + _vocabulary(15, 1500),
    "",
)


check(
    "topic_terms",
    """
select cast(topic as int) as topic, cast(10 as bigint) as n_terms, cast(10 as bigint) as n_known,
       cast(10 as bigint) as n_distinct, 10 as last_rank, 1e0 as top_rel_weight, true as first_is_heaviest
from range(3) as t(topic)""",
    "",
)
check(
    "topic_fit",
    """,
texts as (select count(*) as n from documents where text <> 'No Negative' and length(text) > 30)
select max(texts.n) as n_texts, count(*) as n_words, cast(sum(term_count) as bigint) as n_tokens,
       case when max(texts.n) < 300 then 'small corpus' else 'large enough' end as size_verdict,
       true as likelihood_below_zero, true as perplexity_agrees, true as better_than_one_topic, true as weights_add_up
from kept, texts""",
    ORACLES["topic_vocab"].rsplit("select term, term_count", 1)[0].rstrip(),
)
check(
    "topic_terms_of_languages",
    rf""",
said as (
  select lang, unnest(regexp_extract_all(lower(text), '\p{{L}}{{3,}}')) as term
  from documents where text <> 'No Negative' and length(text) > 30 and lang is not null
),
numbered as (select term, row_number() over (order by term_count desc, term) - 1 as idx from kept),
counts as (select lang, term, idx, count(*) as n from said join numbered using (term) group by all),
topics as (select lang, row_number() over (order by lang) - 1 as topic from (select distinct lang from counts)),
ranked as (
  select topic, term, n / sum(n) over (partition by topic) as weight,
         row_number() over (partition by topic order by n desc, idx) as rank
  from counts join topics using (lang)
),
labels as (select topic, string_agg(term, ', ' order by rank) as label, max(weight) as top from ranked where rank <= 3 group by topic)
select cast(topic as int) as topic, cast(rank as int) as rank, term, round(weight, 9) as weight,
       round(weight / top, 9) as rel_weight, label
from ranked join labels using (topic) where rank <= 10""",
    ORACLES["topic_vocab"].rsplit("select term, term_count", 1)[0].rstrip(),
)
check("topic_stability", " select cast(3 as bigint) as n_main, cast(3 as bigint) as n_alt, true as overall_is_mean, true as verdict_follows", "")


def _language_terms(name: str, source: str) -> str:
    return rf"""
{name}_words as (
  select lang, unnest(regexp_extract_all(lower(text), '\p{{L}}{{3,}}')) as term
  from {source} where text <> 'No Negative' and length(text) > 30
),
{name}_counts as (
  select lang, term, row_number() over (partition by lang order by count(*) desc, term) as rank
  from {name}_words where term not in ({_literals(ENGLISH_STOP_WORDS + DOMAIN_STOP_WORDS)}) group by lang, term
),
{name} as (
  select row_number() over (order by lang) - 1 as topic, list(term) as terms
  from {name}_counts where rank <= 10 group by lang
)"""


check(
    "topic_matching",
    f"""
with recursive {_language_terms("main", "documents")},
{_language_terms("alternative", "(select d.* from documents d join labels l on d.doc_id = l.doc_id)")},
pairs as (
  select m.topic as i, a.topic as j,
         len(list_intersect(m.terms, a.terms)) / len(list_distinct(m.terms || a.terms)) as similarity
  from main m, alternative a
),
steps as (
  select cast(-1 as bigint) as i, cast([] as bigint[]) as used, cast(null as bigint) as j,
         cast(null as double) as similarity
  union all
  select i, used, j, similarity from (
    select p.i, list_append(s.used, p.j) as used, p.j, p.similarity,
           row_number() over (order by p.similarity desc, p.j) as choice
    from steps s join pairs p on p.i = s.i + 1 and not list_contains(s.used, p.j)
  ) where choice = 1
),
matched as (select i, j, similarity, avg(similarity) over () as mean from steps where i >= 0)
select cast(i as int) as topic_main, cast(j as int) as topic_alt, round(similarity, 6) as jaccard,
       round(mean, 6) as overall,
       case when mean < 0.35 then 'low' when mean < 0.55 then 'medium' else 'good' end as verdict
from matched""",
    "",
)

"""DuckDB SQL for the registered queries."""

from __future__ import annotations

from ruleweave.defaults import JUDGE_WORDS, SEED, SYSTEM_PROMPT
from ruleweave.functions.text import MISSING_TOKENS, REFUSED_HOST_PATTERN, URL_PATTERN

BASE = """
select d.doc_id as row_id, d.text as body, d.lang as rule, d.source as subreddit,
       cast(l.toxic as integer) as rule_violation
from documents d left join labels l on d.doc_id = l.doc_id
"""

COMMENTS = """
with lab as (
  select d.doc_id, d.lang, d.text, l.toxic,
         row_number() over (partition by d.lang, l.toxic order by d.doc_id) - 1 as ix,
         count(*) over (partition by d.lang, l.toxic) as n
  from documents d join labels l on d.doc_id = l.doc_id),
cnt as (select distinct lang, toxic, n from lab),
b as (
  select d.doc_id as row_id, d.text as body, d.lang as rule, d.source as subreddit,
         cast(l.toxic as integer) as rule_violation, p.n as np, q.n as nn
  from documents d
  left join labels l on d.doc_id = l.doc_id
  left join cnt p on p.lang = d.lang and p.toxic = 1
  left join cnt q on q.lang = d.lang and q.toxic = 0)
select b.row_id, b.body, b.rule, b.subreddit, b.rule_violation,
       p1.text as positive_example_1, p2.text as positive_example_2,
       n1.text as negative_example_1, n2.text as negative_example_2
from b
left join lab p1 on p1.lang = b.rule and p1.toxic = 1 and p1.ix = b.row_id % b.np
left join lab p2 on p2.lang = b.rule and p2.toxic = 1 and p2.ix = (b.row_id + 1) % b.np
left join lab n1 on n1.lang = b.rule and n1.toxic = 0 and n1.ix = b.row_id % b.nn
left join lab n2 on n2.lang = b.rule and n2.toxic = 0 and n2.ix = (b.row_id + 1) % b.nn
"""

VECTORS = """
select d.text, cast(arg_min(e.embedding, d.doc_id) as double[]) as embedding
from documents d join embeddings e on e.vec_id = d.doc_id group by d.text
"""

PAIRS = """
select a.vec_id, [x::double * (a.vec_id % 5) for x in a.embedding] as a, cast(b.embedding as double[]) as b
from embeddings a join embeddings b on b.vec_id = a.vec_id + 1
"""

EXCHANGES = """
select u.conv_id, a.turn, u.text as prompt, a.text as completion
from conversations u join conversations a
  on a.conv_id = u.conv_id and a.turn = u.turn + 1 and u.role = 'user' and a.role = 'assistant'
"""

LINKED = "select page_id as row_id, concat('see ', url, ' now') as body from pages"

TEXT_COLUMNS = (
    "body", "rule", "subreddit", "positive_example_1", "positive_example_2", "negative_example_1", "negative_example_2",
)

LETTERS = r"[\p{L}\p{N}]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def draw(tag: str, *keys: str) -> str:
    parts = ", ".join(f"cast({k} as varchar)" for k in keys)
    return f"('0x' || substr(md5(concat_ws('|', {quoted(tag)}, '{SEED}', {parts})), 1, 15))::bigint"


def pick(first: str, second: str, tag: str, *keys: str) -> str:
    return f"case when {draw(tag, *keys)} % 2 = 0 then {first} else {second} end"


def vector_text(v: str) -> str:
    return f"array_to_string([cast(cast(round(x * 1000000) as bigint) as varchar) for x in {v}], ',')"


def norm(v: str) -> str:
    return f"sqrt(list_dot_product({v}, {v}))"


def unit(v: str) -> str:
    return f"[coalesce(x / nullif({norm(v)}, 0), 0) for x in {v}]"


def cosine(a: str, b: str) -> str:
    return (
        f"case when {a} is not null and {b} is not null then "
        f"coalesce(list_dot_product({a}, {b}) / nullif({norm(a)} * {norm(b)}, 0), 0) end"
    )


def clean(text: str) -> str:
    """URL cleaning: the gaps between URLs and the tags of the URLs, put together alternately."""
    pat = quoted(URL_PATTERN)
    path = r"regexp_replace(regexp_extract(u, '^https?://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"
    domain = "replace(lower(regexp_extract(u, '^https?://([^/?#]*)', 1)), 'www.', '')"
    parts = f"[p for p in string_split({path}, '/') if p != ''][1:2]"
    tag = (
        f"case when regexp_matches(regexp_extract(u, '^https?://([^/?#]*)', 1), {quoted(REFUSED_HOST_PATTERN)}) "
        f"then '<url>: (unknown)' else '<url>: (' || array_to_string(list_concat([{domain}], {parts}), '/') || ')' end"
    )
    tags = f"[{tag} for u in regexp_extract_all({text}, {pat})]"
    gaps = f"string_split_regex({text}, {pat})"
    pieces = f"[z[1] || coalesce(z[2], '') for z in list_zip({gaps}, {tags})]"
    return f"case when {text} is not null then array_to_string({pieces}, '') end"


def text_or_nan(value: str) -> str:
    return f"coalesce(cast({value} as varchar), 'nan')"


def prompt(positive: str = "positive_example", negative: str = "negative_example") -> str:
    return " || ".join(
        [
            quoted(f"{SYSTEM_PROMPT}\nSubreddit: r/"),
            text_or_nan("subreddit"),
            quoted("\nRule: "),
            text_or_nan("rule"),
            quoted("\nExamples:\n1) "),
            text_or_nan(positive),
            quoted(f"\n{JUDGE_WORDS} Yes\n2) "),
            text_or_nan(negative),
            quoted(f"\n{JUDGE_WORDS} No\nComment: "),
            text_or_nan("body"),
            quoted(f"\n{JUDGE_WORDS}"),
        ]
    )


DRAWN_POSITIVE = pick("positive_example_1", "positive_example_2", "prompt-positive", "row_id")
DRAWN_NEGATIVE = pick("negative_example_1", "negative_example_2", "prompt-negative", "row_id")
TOKEN = "case rule_violation when 1 then 'Yes' when 0 then 'No' end"


def unpivot(source: str) -> str:
    branches = []
    for side, other, label in (("positive", "negative", 1), ("negative", "positive", 0)):
        for i in (1, 2):
            drawn = pick(f"{other}_example_1", f"{other}_example_2", f"pseudo-{side}-{i}", "row_id")
            branches.append(
                f"select rule, subreddit, {side}_example_{i} as body, {side}_example_{3 - i} as {side}_example, "
                f"{drawn} as {other}_example, {label} as rule_violation from {source}"
            )
    return " union all by name ".join(branches)


def ranked(source: str, tag: str, fraction: str) -> str:
    return (
        f"select * exclude (rn, n) from (select *, row_number() over (partition by rule order by "
        f"{draw(tag, 'row_id')}, row_id) as rn, count(*) over (partition by rule) as n from {source} "
        f"where rule is not null) where rn <= round_even({fraction}::double * n, 0)"
    )


SIDES = """
select distinct rule as rule_key, violating, text from (
  select rule, true as violating, unnest([positive_example_1, positive_example_2]) as text from comments
  union all
  select rule, false, unnest([negative_example_1, negative_example_2]) from comments)
where rule is not null and text is not null
"""

ZERO = "[0.0::double for x in range(64)]"


def centroids(vectors: str) -> str:
    """CTEs from ``comments`` to ``centroids``; ``vectors`` is SQL giving (text, embedding)."""
    return f"""
vectors as ({vectors}),
members as ({SIDES} union all select distinct rule, false, rule from comments where rule is not null),
means as (
  select rule_key, violating, list(m order by i) as v from (
    select rule_key, violating, i, avg(x) as m from (
      select rule_key, violating, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i
      from members join vectors using (text)) group by rule_key, violating, i)
  group by rule_key, violating),
centroids as (
  select r.rule_key, coalesce(p.v, {ZERO}) as violating_centroid, coalesce(q.v, {ZERO}) as non_violating_centroid
  from (select distinct rule_key from members) r
  left join means p on p.rule_key = r.rule_key and p.violating
  left join means q on q.rule_key = r.rule_key and not q.violating)"""


def scored(metric: str = "cosine") -> str:
    """CTE ``scored`` after ``centroids``."""
    if metric == "cosine":
        sv, sn, test = cosine("e", "p"), cosine("e", "q"), "sv > sn"
    else:
        sv, sn, test = "list_distance(e, p)", "list_distance(e, q)", "sv < sn"
    return f"""
looked_up as (
  select c.row_id, v.embedding as e, k.violating_centroid as p, k.non_violating_centroid as q
  from comments c left join vectors v on v.text = c.body left join centroids k on k.rule_key = c.rule),
scored as (
  select row_id, sv, sn, case when {test} then 1 else 0 end as rule_violation
  from (select row_id, {sv} as sv, {sn} as sn from looked_up))"""


CLASSIFIED = f"with comments as ({COMMENTS}), {centroids(VECTORS)}, {scored()}"

HASHED = f"""
select text, {unit('counts')} as embedding from (
  select text, [len([b for b in buckets if b = i])::double for i in range(64)] as counts from (
    select text, [('0x' || substr(md5(w), 1, 8))::bigint % 64 for w in regexp_extract_all(lower(text), '{LETTERS}')]
      as buckets from (SOURCE)))
"""

POOL = f"""
train as (select * from ({BASE}) where rule_violation is not null),
test as (select * exclude (rule_violation) from ({BASE}) where rule_violation is null),
pool as (
  select row_id as pool_id, rule, subreddit, body,
         row_number() over (order by coalesce(sha256(rule), ''), coalesce(sha256(subreddit), ''),
                            {draw('pool', 'row_id')}, row_id) - 1 as ix
  from train),
rules as (select rule, min(ix) as rs, count(*) as nr from pool group by rule),
communities as (select rule, subreddit, min(ix) as cs, count(*) as nc from pool group by rule, subreddit),
total as (select count(*) as n from pool)"""


def picks(*keys: str) -> str:
    """CTEs ``positives`` and ``negatives`` (keys, ix) after POOL and ``anchors``."""
    cols = ", ".join(f"a.{k}" for k in keys)
    named = ", ".join(keys)
    return f"""
positives as (
  select {named}, rs + case when k < st then k else k + own end as ix from (
    select *, {draw('positive', *keys)} % (nr - own) as k from (
      select {cols}, r.rs, r.nr, coalesce(c.nc, 0) as own, coalesce(c.cs - r.rs, r.nr) as st
      from anchors a join rules r on r.rule = a.rule
      left join communities c on c.rule = a.rule and c.subreddit = a.subreddit)
    where nr > own)),
negatives as (
  select {named}, case when k < st then k else k + own end as ix from (
    select *, {draw('negative', *keys)} % (n - own) as k from (
      select {cols}, t.n, coalesce(r.nr, 0) as own, coalesce(r.rs, t.n) as st
      from anchors a left join rules r on r.rule = a.rule, total t)
    where n > own))"""


TRIPLETS = f"""
with {POOL},
anchors as (select row_id, 0 as draw_no, rule, subreddit, body from test),
{picks('row_id', 'draw_no')},
triplets as (
  select a.row_id, a.body as anchor, p.body as positive, n.body as negative
  from anchors a
  join positives x on x.row_id = a.row_id join pool p on p.ix = x.ix
  join negatives y on y.row_id = a.row_id join pool n on n.ix = y.ix)"""


def partner(role: str) -> str:
    return f"""
with {POOL}, anchors as (select row_id, rule, subreddit from test), {picks('row_id')}
select s.row_id, p.pool_id, p.rule, p.subreddit from {role} s join pool p on p.ix = s.ix"""


def comments_then(select: str) -> str:
    return f"with comments as ({COMMENTS}) {select}"


def base_then(select: str) -> str:
    return f"with base as ({BASE}) {select}"


def classifier(train: str, asked: str) -> str:
    """CTEs ``replies`` (row_id, score, reply) from SQL giving (text, label) and (row_id, text)."""
    buckets = f"list_distinct([('0x' || substr(md5(w), 1, 8))::bigint % 65536 for w in regexp_extract_all(lower(text), '{LETTERS}')])"
    return f"""
texts as (
  select row_number() over () as r, null as row_id, label, text from ({train}) where text is not null and label is not null
  union all select -row_number() over (), row_id, null, text from ({asked}) where text is not null),
sizes as (select count(*) filter (label = 1)::double as n1, count(*) filter (label = 0)::double as n0 from texts),
found as (select r, label, unnest({buckets}) as b from texts),
seen as (select b, count(*) as d from found where label is not null group by b),
raised as (
  select r, label, found.b, ln((n1 + n0 + 1) / (coalesce(d, 0) + 1)) as z
  from found left join seen on seen.b = found.b, sizes),
lengths as (select r, sqrt(sum(z * z)) as len from raised group by r),
units as (
  select raised.r, label, b, case when len > 0 then z / len else 0 end as v from raised join lengths on lengths.r = raised.r),
weights as (
  select b, (coalesce(sum(v) filter (label = 1), 0) / n1 - coalesce(sum(v) filter (label = 0), 0) / n0)
            / (sum(v * v) / (n1 + n0) + 0.00001::double) as w
  from units, sizes where label is not null group by b, n1, n0),
raw as (
  select t.r, t.row_id, t.label, coalesce(sum(v * coalesce(w, 0)), 0) as s
  from texts t left join units u on u.r = t.r left join weights k on k.b = u.b group by t.r, t.row_id, t.label),
line as (
  select (m1 - m0) / greatest((n1 * v1 + n0 * v0) / (n1 + n0), 1e-12) as slope, (m1 + m0) / 2 as middle, ln(n1 / n0) as prior
  from sizes, (select avg(s) filter (label = 1) as m1, avg(s) filter (label = 0) as m0,
                      var_pop(s) filter (label = 1) as v1, var_pop(s) filter (label = 0) as v0 from raw)),
replies as (
  select row_id, score, case when score > 0.5 then 'Yes' else 'No' end as reply
  from (select row_id, 1 / (1 + exp(-(slope * (s - middle) + prior))) as score from raw, line where r < 0))"""


def half_rounds(x: str, source: str, keys: str) -> str:
    """The network of one step on ``x``, as nested selects that add ``y``; rows carry ``low`` and ``high``."""
    inner = f"select *, {x} // low as a0, {x} % low as b0 from {source}"
    for r in range(4):
        size = "high" if r % 2 == 0 else "low"
        inner = (
            f"select *, b{r} as a{r + 1}, (a{r} + {draw('batches-epoch', str(r), keys, f'b{r}')}) % {size} as b{r + 1} from ({inner})"
        )
    return f"select *, a4 * low + b4 as y from ({inner})"


def oracle_sql() -> dict[str, str]:
    tokens = ", ".join(quoted(t) for t in MISSING_TOKENS)
    cells = f"[{tokens}, 'na', 'NAN', 'none', '0']"
    drawn = f"select *, {DRAWN_POSITIVE} as positive_example, {DRAWN_NEGATIVE} as negative_example from comments"
    pseudo_source = "(select * from comments where rule_violation is null)"
    scores = "round(sv, 6) as violating_score, round(sn, 6) as non_violating_score"
    loss = "avg(greatest(0.0, {p} - {n} + 0.25::double))"
    hashed_members = HASHED.replace("SOURCE", "select distinct text from candidate_texts where text is not null")
    return {
        "scan_comments": comments_then(f"""
            select row_id, rule_violation, {", ".join(f"case when {c} not in ({tokens}) then {c} end as {c}" for c in TEXT_COLUMNS)}
            from comments"""),
        "normalize_missing": f"""
            select row_id, {", ".join(f"case when {c} not in ({tokens}) then {c} end as {c}" for c in ("text", "lang", "source"))}
            from (select doc_id as row_id, text, lang, source from documents
                  union all select -i, {cells}[i], {cells}[i], {cells}[i] from range(1, {len(MISSING_TOKENS) + 5}) r(i))""",
        "write_submission": base_then(
            "select row_id, rule_violation::double as rule_violation from base where rule_violation is not null"
        ),
        "read_predictions_pair": """
            with l as (select nullif(doc_id, 0) as row_id, toxic::double as toxic, quality::double as quality from labels)
            select a.row_id, a.toxic as rule_violation_llm, b.quality as rule_violation_gte
            from l a join l b on a.row_id is not distinct from b.row_id""",
        "load_clean": f"""
            select row_id, {clean('body')} as body
            from (select row_id, body from ({LINKED})
                  union all select -1 - row_id, null from ({LINKED}) where row_id % 10 = 0)""",
        "clean_urls": f"select row_id, {clean('body')} as body from ({LINKED})",
        "build_prompt": comments_then(f"select row_id, {prompt()} as prompt from ({drawn})"),
        "label_to_token": base_then(f"select row_id, {TOKEN} as token from base"),
        "pick_example": comments_then(f"select row_id, positive_example, negative_example from ({drawn})"),
        "binarize_score": """
            select event_id, cast(coalesce(value / 100 > 0.5 and not isnan(value), false) as integer) as label
            from events""",
        "sft_text": f"select conv_id, turn, prompt || completion as text from ({EXCHANGES})",
        "select_columns": comments_then("select rule, subreddit, row_id, positive_example_1 from comments"),
        "unpivot_examples": comments_then(unpivot("comments")),
        "constant_label": comments_then(
            f"select rule, rule_violation, count(*) as n_rows from ({unpivot('comments')}) group by all"
        ),
        "strip_prompt": f"""
            select conv_id, turn, substr(prompt || completion, length(prompt) + 1) as reply from ({EXCHANGES})""",
        "reply_to_label": """
            select doc_id, coalesce(case when quality = 0 then lower(t) else t end = 'Yes', false) as is_positive
            from (select doc_id, quality, case toxic when 1 then 'Yes' when 0 then 'No' end as t from labels)""",
        "str_or_nan": base_then(f"select row_id, {text_or_nan('rule_violation')} as label_text from base"),
        "l2_normalize": f"select vec_id, {vector_text(unit('a'))} as unit from ({PAIRS})",
        "cosine_similarity": f"select vec_id, round({cosine('a', 'b')}, 6) as similarity from ({PAIRS})",
        "euclidean_distance": f"select vec_id, round(list_distance(a, b), 6) as distance from ({PAIRS})",
        "nearest_side": f"{CLASSIFIED} select row_id, {scores}, rule_violation from scored",
        "nearest_side_euclidean": f"""
            with comments as ({COMMENTS}), {centroids(VECTORS)}, {scored('euclidean')}
            select row_id, {scores}, rule_violation from scored""",
        "filter_not_missing": base_then("select row_id, rule_violation from base where rule_violation is not null"),
        "filter_rule": base_then("select row_id, body from base where rule = 'en'"),
        "filter_known_text": base_then(
            f"select row_id from base where body in (select text from ({VECTORS}))"
        ),
        "filter_nonempty_pool": base_then("""
            , seen as (select rule, subreddit from base where rule_violation is not null),
            t as (select * from seen union all
                  select 'solo rule', 'one community' from base where rule_violation is not null and row_id % 11 = 0),
            a as (select row_id, rule, subreddit from base where rule_violation is null
                  union all select -1 - row_id, 'no such rule', subreddit from base
                    where rule_violation is null and row_id % 7 = 0
                  union all select -1 - row_id, 'solo rule', 'one community' from base
                    where rule_violation is null and row_id % 7 = 1)
            select * from (
              select a.row_id,
                (select count(*) from t where t.rule = a.rule)
                  - (select count(*) from t where t.rule = a.rule and t.subreddit = a.subreddit) as positive_pool,
                (select count(*) from t) - (select count(*) from t where t.rule = a.rule) as negative_pool
              from a)
            where positive_pool > 0 and negative_pool > 0"""),
        "join_predictions": """
            with l as (select nullif(doc_id, 0) as row_id, toxic, quality from labels)
            select a.row_id, cast(a.toxic as integer) as rule_violation_llm,
                   cast(b.quality as integer) as rule_violation_gte
            from l a join l b on a.row_id is not distinct from b.row_id""",
        "join_positive": partner("positives"),
        "join_negative": partner("negatives"),
        "join_text_embedding": base_then(f"""
            , v as ({VECTORS})
            select row_id, {vector_text('v.embedding')} as embedding from base left join v on v.text = base.body"""),
        "join_rule_centroid": f"""
            with comments as ({COMMENTS}), {centroids(VECTORS)}
            select row_id, rule_key, {vector_text('violating_centroid')} as violating_centroid,
                   {vector_text('non_violating_centroid')} as non_violating_centroid
            from comments left join centroids on rule_key = rule""",
        "align_predictions": base_then(f"""
            select base.row_id, {TOKEN} as reply, l.toxic as label from base join labels l on l.doc_id = base.row_id"""),
        "distinct_texts": comments_then("""
            select distinct text from (
              select unnest([body, rule, positive_example_1, positive_example_2, negative_example_1,
                             negative_example_2]) as text from comments)
            where text is not null"""),
        "distinct_rules": "select distinct lang as rule from documents",
        "side_text_sets": comments_then(SIDES),
        "rule_centroids": f"""
            with comments as ({COMMENTS}), {centroids(VECTORS)}
            select rule_key, {vector_text('violating_centroid')} as violating_centroid,
                   {vector_text('non_violating_centroid')} as non_violating_centroid
            from centroids""",
        "drop_duplicates": comments_then(f"select distinct * from ({unpivot('comments')})"),
        "stage_counts": f"""
            {TRIPLETS}, base as ({BASE}), comments as ({COMMENTS}),
            chosen as ({ranked(pseudo_source, 'pseudo', '0.05')}),
            pseudo as (select distinct * from ({unpivot('chosen')}))
            select 'loaded' as stage, count(*) as n_rows from base
            union all select 'train', count(*) from base where rule_violation is not null
            union all select 'sampled', count(*) from chosen
            union all select 'pseudo', count(*) from pseudo
            union all select 'total', count(*) from (
              select 1 from base where rule_violation is not null union all select 1 from pseudo)
            union all select 'triplets', count(*) from triplets
            union all select 'distinct_texts', count(distinct body) from base""",
        "union_with_missing": base_then("""
            select row_id, body, rule_violation from base where rule_violation is not null
            union all by name
            select row_id, subreddit, body from base where rule_violation is null"""),
        "union_slices": comments_then("""
            select row_id, positive_example_1 as body, 1 as rule_violation from comments
            union all select row_id, positive_example_2, 1 from comments
            union all select row_id, negative_example_1, 0 from comments
            union all select row_id, negative_example_2, 0 from comments"""),
        "sample_stratified": base_then(f"select row_id, rule from ({ranked('base', 'pseudo', '0.05')})"),
        "sample_n": base_then(
            f"select row_id, rule from base order by {draw('subsample', 'row_id')}, row_id limit 100"
        ),
        "head_n": base_then("select row_id, rule from base order by row_id limit 100"),
        "shuffle_batches": f"""
            {TRIPLETS}
            select row_id, 0 as draw_no, ix // 32 as batch_id, cast(ix % 32 as integer) as batch_pos from (
              select row_id,
                     row_number() over (order by {draw('batches', 'row_id', '0')}, row_id) - 1 as ix from triplets)""",
        "shuffle_epochs": f"""
            {TRIPLETS.replace("with", "with recursive", 1)},
            numbered as (
              select row_id, row_number() over (order by {draw('batches', 'row_id', '0')}, row_id) - 1 as ix,
                     count(*) over () as n from triplets),
            sized as (
              select *, cast(ceil(sqrt(n::double)) as bigint) as low from numbered),
            spread as (select *, (n + low - 1) // low as high, unnest([1, 2]) as epoch from sized),
            walk as (
              select row_id, epoch, n, low, high, y from ({half_rounds('ix', 'spread', 'epoch')})
              union all
              select row_id, epoch, n, low, high, z from (
                select row_id, epoch, n, low, high, y as z from ({half_rounds('x', '(select row_id, epoch, n, low, high, y as x from walk where y >= n)', 'epoch')}))),
            placed as (
              select row_id, 0 as epoch, ix as place from numbered
              union all select row_id, epoch, y from walk where y < n)
            select row_id, 0 as draw_no, epoch, place // 32 as batch_id, cast(place % 32 as integer) as batch_pos from placed""",
        "batch_plan": f"""
            {TRIPLETS}
            select n_rows, n_batches, cast(floor(n_batches::double * 0.1::double) as bigint) as warmup_steps from (
              select n_rows, cast(ceil(n_rows / 32) as bigint) as n_batches from (
                select count(*) as n_rows from triplets))""",
        "pseudo_training_set": comments_then(f"""
            , sampled as ({ranked('comments', 'pseudo', '0.05')})
            select distinct * from ({unpivot('sampled')})"""),
        "prompt_dataset": comments_then(f"""
            , sampled as ({ranked(pseudo_source, 'pseudo', '0.05')}),
            pseudo as (select distinct * from ({unpivot('sampled')})),
            train as (select * from ({drawn}) where rule_violation is not null)
            select {prompt()} as prompt, {TOKEN} as completion from train
            union all select {prompt()}, {TOKEN} from pseudo"""),
        "triplet_dataset": f"{TRIPLETS} select anchor, positive, negative from triplets",
        "centroid_classify": f"{CLASSIFIED} select row_id, rule_violation from scored",
        "ensemble_weighted": f"""
            {CLASSIFIED}
            select row_id, cast(toxic * 0.6::double + rule_violation * 0.4::double > 0.5 as integer) as rule_violation
            from scored join labels on doc_id = row_id""",
        "ensemble_override": f"""
            {CLASSIFIED}
            select row_id, case when toxic = 1 then 1 else rule_violation end as rule_violation
            from scored left join labels on doc_id = row_id""",
        "full_inference": f"""
            with comments as ({COMMENTS}),
            candidate_texts as (
              select unnest([body, rule, positive_example_1, positive_example_2, negative_example_1,
                             negative_example_2]) as text from comments),
            {centroids(hashed_members)}, {scored()}
            select row_id, case when toxic = 1 then 1 else rule_violation end as rule_violation
            from scored left join labels on doc_id = row_id""",
        "score_batches": """
            select doc_id as row_id,
                   case when length(text) = 0 then 0.0 else
                     round((length(text) - length(replace(text, 'e', '')))::double / length(text), 6) end as value
            from documents""",
        "embed_texts": f"""
            select sha256(text) as text_key, {vector_text('embedding')} as embedding
            from ({HASHED.replace('SOURCE', 'select distinct text from documents where text is not null')})""",
        "score_text_classifier": f"""
            with comments as ({COMMENTS}),
            prompts as (select row_id, rule_violation as label, {prompt()} as text from ({drawn})),
            {classifier("select text, label from prompts", "select row_id, text from prompts")}
            select row_id, round(score, 6) as score, reply from replies""",
        "train_infer_combine": f"""
            with every as ({COMMENTS}),
            comments as (select * exclude (rule_violation) from every where rule_violation is null),
            sampled as ({ranked('comments', 'pseudo', '0.05')}),
            pseudo as (select distinct * from ({unpivot('sampled')})),
            train as (select * from ({drawn.replace('from comments', 'from every')}) where rule_violation is not null),
            {classifier(
                f"select {prompt()} as text, rule_violation as label from train union all select {prompt()}, rule_violation from pseudo",
                f"select row_id, {prompt()} as text from ({drawn})")},
            candidate_texts as (
              select unnest([body, rule, positive_example_1, positive_example_2, negative_example_1,
                             negative_example_2]) as text from comments),
            {centroids(hashed_members)}, {scored()}
            select s.row_id,
                   cast((case when reply = 'Yes' then 1 else 0 end) * 0.6::double + s.rule_violation * 0.4::double > 0.5 as double)
                     as rule_violation
            from scored s join replies r on r.row_id = s.row_id""",
        "triplet_margin_loss": f"""
            {TRIPLETS}, vectors as ({VECTORS}),
            found as (
              select a.embedding as a, p.embedding as p, n.embedding as n
              from triplets join vectors a on a.text = anchor join vectors p on p.text = positive
              join vectors n on n.text = negative)
            select 'cosine' as metric, count(*) as n_triplets,
                   round({loss.format(p=f'(1 - {cosine("a", "p")})', n=f'(1 - {cosine("a", "n")})')}, 6) as mean_loss
            from found
            union all
            select 'euclidean', count(*),
                   round({loss.format(p='list_distance(a, p)', n='list_distance(a, n)')}, 6) from found""",
        "keyed_draw": f"select doc_id, {draw('check', 'doc_id', 'lang')} as draw from documents",
    }

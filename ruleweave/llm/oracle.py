"""DuckDB SQL for the operators whose whole result SQL can express."""

from __future__ import annotations

from ruleweave.llm import mixing, quality

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def removed(chars: str) -> str:
    return f"length(t) - length(translate(t, {quoted(chars)}, ''))"


QUALITY = f"""
with d as (
  select doc_id, row_number() over () as r, coalesce(text, '') as t from documents),
w as (
  select doc_id, r, t, regexp_extract_all(t, {quoted(WORD)}) as ws,
         [x for x in string_split(t, chr(10)) if regexp_matches(x, {quoted(WORD)})] as ls from d),
windows as (
  select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g
  from (select r, ws, unnest(range(1, len(ws) - 1)) as i from w)),
twice as (select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1),
inside as (select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from twice) group by r),
m as (
  select doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
         {removed(quality.SYMBOLS)} as n_symbols, len(ls) - len(list_distinct(ls)) as n_dup_lines,
         coalesce(n, 0) as n_repeat_words, len(ls) as n_lines, {removed('!')} as n_excl, {removed(quality.UPPER)} as n_upper,
         len([x for x in ws if lower(x) in ({', '.join(map(quoted, dict.fromkeys(quality.STOP_WORDS)))})]) as n_stop
  from w left join inside using (r)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    concat_ws(',',
      case when not (word_chars / greatest(n_words, 1) between 2.0 and 14.0) then 'mean_word_length' end,
      case when not n_symbols / greatest(n_words, 1) <= 0.1 then 'symbols_per_word' end,
      case when not n_excl / greatest(n_words, 1) <= 0.3 then 'exclamations_per_word' end,
      case when not n_upper / greatest(word_chars, 1) <= 0.4 then 'upper_case_share' end,
      case when not n_stop / greatest(n_words, 1) >= 0.04 then 'stop_word_share' end,
      case when not n_dup_lines / greatest(n_lines, 1) <= 0.5 then 'duplicate_line_share' end) as failed_rules
  from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and failed_rules = '' as kept, failed_rules
from judged
"""

JACCARD = f"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {quoted(WORD)}) as ws
  from documents),
s as (
  select distinct doc_id, array_to_string(ws[i : i + 4], ' ') as g
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) as i from d)),
n as (select doc_id, count(*) as n from s group by doc_id),
overlap as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id != b.doc_id group by all),
link as (
  select a, b from overlap join n x on x.doc_id = a join n y on y.doc_id = b where c >= 0.8 * (x.n + y.n - c) - 1e-9
  union all
  select x.doc_id, y.doc_id from d x join d y on len(x.ws) = 0 and len(y.ws) = 0 and x.doc_id != y.doc_id),
reach(a, b) as (
  select doc_id, doc_id from d union select reach.a, link.b from reach join link on reach.b = link.a)
select d.doc_id, (select min(b) from reach where a = d.doc_id) as class_id,
       (select count(*) from link where a = d.doc_id) as n_links
from d
"""

_TEXT = "coalesce(text, '')"
_DRAW = (
    f"('0x' || substr(md5(concat_ws('|', 'mix', '{mixing.SEED}', coalesce(cast(doc_id as varchar), ''), md5({_TEXT}))), 1, 15))"
    "::bigint"
)
_SHARE = (
    f"greatest(length(translate({_TEXT}, {quoted(mixing.SYMBOLS)}, '')) / greatest(length({_TEXT}), 1), {mixing.LEAST_QUALITY}::double)"
)

MIX = f"""
with d as (
  select doc_id, source, len(regexp_extract_all({_TEXT}, {quoted(WORD)})) as size,
         -ln(({_DRAW} + 0.5::double) / 1152921504606846976::double)
           / case when {_TEXT} = '' then 1.0::double else {_SHARE} end as k
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (
  select *, [1.0, 2.0, 3.0][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double as w,
         source_size * 3.0::double as most from s),
l as (
  select *, (sum(source_size) over ()
             - coalesce(sum(most) over (order by most / w, source nulls last rows between unbounded preceding and 1 preceding), 0))
            / sum(w) over (order by most / w, source nulls last rows between current row and unbounded following) as level from w),
chosen as (select arg_min(level, most / w) as level from l where level * w <= most),
t as (select source, source_size, least(w * chosen.level, most) as target from l, chosen),
e as (select *, case when source_size > 0 then cast(least(floor(target / source_size), 3) as bigint) else 0 end as epochs from t),
b as (select *, case when epochs >= 3 then 0 else target - epochs * source_size end as budget from e),
p as (
  select d.*, source_size, target, epochs, budget,
         coalesce(sum(size) over (partition by d.source order by k, size rows between unbounded preceding and 1 preceding), 0)
           as before
  from d join b on d.source is not distinct from b.source)
select doc_id, source, size, source_size, target,
       cast((epochs + case when before + size / 2 <= budget and budget > before then 1 else 0 end) * size as bigint) as taken
from p
"""


WARC = """
with p as (
  select row_number() over () as r, page_id, url, coalesce(html, '') as html from pages),
o as (
  select *, strlen(html) as n, first_value(page_id) over w as first, row_number() over w as place
  from p window w as (partition by html order by page_id nulls last, url nulls first, r))
select page_id, n as payload_bytes, sha256(html) as payload_digest,
       case when n < 100 or place = 1 then 'response' else 'revisit' end as record_type,
       case when n < 100 or place = 1 then null else first end as refers_to, 'ok' as status
from o
"""


def _leaf(text: str) -> str:
    fields = [f"cast({c} as varchar)" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f})::varchar || ':' || {f}, '-')" for f in fields) + ")"


_LOWERED = f"translate(text, '{UPPER}', '{LOWER}')"
# crc32 of the id, digit by digit: DuckDB has no function for it.
_CRC_STEP = "case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end"

# Heights are unrolled by recursion: a level holds (tree, rank, n, digest), the tree of the sources being number -1.
MANIFEST = f"""
with recursive crc(id, t, i, b, c) as (
  select doc_id, coalesce(cast(doc_id as varchar), ''), 0, 0, 4294967295::bigint from (select distinct doc_id from documents)
  union all
  select id, t, case when b = 8 then i + 1 else i end, case when b = 8 then 0 else b + 1 end,
         case when b = 0 then xor(c, ascii(t[i + 1])::bigint)
              else {_CRC_STEP} end
  from crc where i < length(t)),
tampered as (select id from crc where i = length(t) and xor(c, 4294967295::bigint) % 5 = 0),
d as (
  select doc_id, source, {_leaf('text')} as leaf,
         case when exists (select 1 from tampered where id is not distinct from doc_id) then {_leaf(_LOWERED)} else {_leaf('text')} end
           as changed
  from documents),
leaves as (
  select *, dense_rank() over (order by source nulls first) - 1 as tree,
         row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as rank,
         count(*) over (partition by source) as n
  from d),
nodes(tree, level, rank, n, digest) as (
  select tree, 0, rank, n, leaf from leaves
  union all
  select tree, level + 1, rank // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by rank))
  from nodes where n > 1 group by tree, level, rank // 16, n),
subroots as (select tree, level as height, digest, count(*) over () as n from nodes where n = 1),
upper(level, rank, n, digest) as (
  select 0, tree, n, digest from subroots
  union all
  select level + 1, rank // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by rank))
  from upper where n > 1 group by level, rank // 16, n),
root as (select digest as root from upper where n = 1),
segments as (
  select a.tree, a.level, a.rank, coalesce(string_agg(b.digest, '' order by b.rank) filter (b.rank < a.rank), '') as before,
         coalesce(string_agg(b.digest, '' order by b.rank) filter (b.rank > a.rank), '') as after
  from nodes a join nodes b on a.tree = b.tree and a.level = b.level and a.rank // 16 = b.rank // 16
  where a.n > 1 group by all),
upper_segments as (
  select a.level, a.rank, coalesce(string_agg(b.digest, '' order by b.rank) filter (b.rank < a.rank), '') as before,
         coalesce(string_agg(b.digest, '' order by b.rank) filter (b.rank > a.rank), '') as after
  from upper a join upper b on a.level = b.level and a.rank // 16 = b.rank // 16
  where a.n > 1 group by all),
powers as (select unnest(range(0, 16)) as level),
steps as (
  select l.tree, l.rank, s.level as step, s.before, s.after
  from leaves l join powers p on true join segments s on s.tree = l.tree and s.level = p.level
    and s.rank = l.rank // power(16, p.level)::bigint
  union all
  select l.tree, l.rank, t.height + u.level, u.before, u.after
  from leaves l join subroots t on t.tree = l.tree join powers p on true
    join upper_segments u on u.level = p.level and u.rank = l.tree // power(16, p.level)::bigint),
proofs as (select tree, rank, sha256(string_agg(before || after, '' order by step)) as proof from steps group by tree, rank),
fold(tree, rank, step, digest) as (
  select tree, rank, 0, changed from leaves
  union all
  select f.tree, f.rank, f.step + 1, sha256(s.before || f.digest || s.after)
  from fold f join steps s on s.tree = f.tree and s.rank = f.rank and s.step = f.step),
folded as (select tree, rank, arg_max(digest, step) as digest from fold group by tree, rank)
select l.doc_id, l.leaf, t.digest as subroot, root, coalesce(p.proof, sha256('')) as proof_sha256, f.digest as folded_root,
       f.digest = root as verified
from leaves l join subroots t on t.tree = l.tree join folded f on f.tree = l.tree and f.rank = l.rank
  left join proofs p on p.tree = l.tree and p.rank = l.rank, root
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_quality_rules": QUALITY,
        "op8_jaccard_join": JACCARD,
        "op9_mix_sources": MIX,
        "op11_warc_pages": WARC,
        "op12_merkle_manifest": MANIFEST,
    }

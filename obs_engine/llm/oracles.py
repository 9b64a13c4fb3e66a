"""DuckDB SQL for the queries that SQL can express."""

# Words and lines as the contract has them; windows of three words by their text.
QUALITY = r"""
with texts as (
  select doc_id, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
), windows as (
  select doc_id, unnest(range(1, len(words) - 1)) as i, words from texts where len(words) >= 3
), named as (
  select doc_id, i, [words[i], words[i + 1], words[i + 2]] as three from windows
), repeated as (
  select doc_id, i from named qualify count(*) over (partition by doc_id, three) > 1
), places as (
  select distinct doc_id, i + d as place from repeated, (values (0), (1), (2)) as t(d)
), covered as (
  select doc_id, count(*) as n from places group by doc_id
), counts as (
  select t.doc_id,
    cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
    cast(length(regexp_replace(text, '[^!]+', '', 'g')) as bigint) as n_shouts,
    cast(len(lines) as bigint) as n_lines,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) as bigint) as n_bullets,
    cast(len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) as bigint) as n_ellipses,
    cast(len(list_filter(words, lambda x: list_contains([{stop}], x))) as bigint) as n_stop_words,
    coalesce(c.n, 0) as n_repeat_words
  from texts t left join covered c on t.doc_id = c.doc_id
), failed as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed
    and word_chars / n_words between 2.0 and 14.0
    and n_symbols / n_words <= 0.3
    and n_shouts / n_words <= 0.3
    and n_stop_words / n_words >= 0.02
    and n_dup_lines / n_lines <= 0.5
    and n_bullets / n_lines <= 0.9
    and n_ellipses / n_lines <= 0.3 as kept
from failed
"""

EXACT = r"""
with texts as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
  from documents
), groups as (
  select *, min(doc_id) over (partition by text_sha256) as keep_id,
    count(*) over (partition by text_sha256) as group_size
  from texts
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from groups
"""

CENTROIDS_HEAD = """
with kept as materialized (
  select row_number() over () as r, vec_id,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) = 64
    and len(list_filter(embedding, lambda x: x is not null and isfinite(cast(x as double)))) = 64
), c0 as materialized (
  select row_number() over (order by sha256('2:' || vec_id), v) - 1 as c, v
  from kept qualify c < 40
)"""

CENTROIDS_ROUND = """, a{i} as materialized (
  select r, vec_id, k.v, c.c,
    list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d
  from kept k, c{i} c
  qualify row_number() over (partition by r order by d, c.c) = 1
)"""

CENTROIDS_MOVE = """, s{i} as materialized (
  select c, place, sum(v[place]) as s, count(*) as n
  from a{i}, (select unnest(range(1, 65)) as place) group by c, place
), c{j} as materialized (
  select c0.c, coalesce(list(cast((s - ((s % n) + n) % n) // n as bigint) order by place)
    filter (s is not null), any_value(c0.v)) as v
  from c{i} c0 left join s{i} s on c0.c = s.c group by c0.c
)"""

CENTROIDS_TAIL = """
select vec_id, cast(a5.c as integer) as cluster, cast(d as bigint) as distance,
  cast(sum(d) over (partition by a5.c) as bigint) as cluster_inertia,
  cast(sum(d) over () as bigint) as inertia,
  sha256(array_to_string(c5.v, ',')) as centroid_sha256
from a5 join c5 on a5.c = c5.c
"""

SIMILAR_SETS = r"""
with recursive texts as (
  select row_number() over () as r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
  from documents
), sets as materialized (
  select r, doc_id, list_sort(list_distinct(case when len(words) < 2 then words
    else list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) end)) as shingles
  from texts
), nodes as materialized (
  select row_number() over () as node, shingles, len(shingles) as n, min(doc_id) as doc_id
  from sets where len(shingles) > 0 group by shingles
), entries as materialized (
  select node, n, unnest(shingles) as shingle from nodes
), links as materialized (
  select a.node as a, b.node as b
  from entries a join entries b
    on a.shingle = b.shingle and a.node < b.node and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.node, b.node, a.n, b.n
  having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), edges as materialized (
  select a, b from links union all select b, a from links
), reach as (
  select node as a, node as b from nodes
  union
  select r.a, e.b from reach r join edges e on r.b = e.a
), lowest as (
  select a as node, min(n.doc_id) as component_id from reach join nodes n on b = n.node group by a
)
select s.doc_id, cast(len(s.shingles) as bigint) as n_shingles,
  coalesce(l.component_id, s.doc_id) as component_id,
  s.doc_id = coalesce(l.component_id, s.doc_id) as kept
from sets s left join nodes n on s.shingles = n.shingles left join lowest l on n.node = l.node
"""

# The bits of the checksum of a decimal number, one step of the remainder for each.
MERKLE = """
with recursive marked as (
  select row_number() over () as r, doc_id, source,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lowered, text,
    {fields} as before,
    xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
      string_split(cast(doc_id as varchar), ''), lambda c: [cast(ord(c) as bigint), 0, 0, 0, 0, 0, 0, 0]))),
      lambda s, v: xor(xor(s, v) >> 1, 3988292384 * (xor(s, v) & 1)))) as crc
  from documents
), leaves as materialized (
  select r, doc_id, source, sha256(before || {text}) as leaf,
    case when crc % 5 = 0 then sha256(before || {lowered}) else sha256(before || {text}) end as own
  from marked
), tree as (
  select 0 as level, source, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as idx,
    leaf as node, count(*) over (partition by source) as n
  from leaves
  union all
  select level + 1, source, idx // 16, sha256(string_agg(node, '' order by idx)), (n + 15) // 16
  from tree where n > 1 group by level, source, idx // 16, n
), nodes as materialized (
  select *, coalesce(string_agg(node, '') over (partition by level, source, idx // 16 order by idx
      rows between unbounded preceding and 1 preceding), '') as left_of,
    coalesce(string_agg(node, '') over (partition by level, source, idx // 16 order by idx
      rows between 1 following and unbounded following), '') as right_of
  from tree
), tops as (
  select source, node as subroot, row_number() over (order by source nulls first) - 1 as place from nodes where n = 1
), upper as (
  select 0 as level, place as idx, subroot as node, count(*) over () as n from tops
  union all
  select level + 1, idx // 16, sha256(string_agg(node, '' order by idx)), (n + 15) // 16
  from upper where n > 1 group by level, idx // 16, n
), above as materialized (
  select *, coalesce(string_agg(node, '') over (partition by level, idx // 16 order by idx
      rows between unbounded preceding and 1 preceding), '') as left_of,
    coalesce(string_agg(node, '') over (partition by level, idx // 16 order by idx
      rows between 1 following and unbounded following), '') as right_of
  from upper
), walk as (
  select r, source, 0 as level, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as idx,
    '' as proof, own as node
  from leaves
  union all
  select w.r, w.source, w.level + 1, w.idx // 16, proof || left_of || right_of, sha256(left_of || w.node || right_of)
  from walk w join nodes t on w.source is not distinct from t.source and w.level = t.level and w.idx = t.idx
  where n > 1
), climbed as (
  select w.r, place, proof, node from walk w join tops t on w.source is not distinct from t.source
  qualify row_number() over (partition by r order by level desc) = 1
), onward as (
  select r, 0 as level, place as idx, proof, node from climbed
  union all
  select w.r, w.level + 1, w.idx // 16, proof || left_of || right_of, sha256(left_of || w.node || right_of)
  from onward w join above t on w.level = t.level and w.idx = t.idx
  where n > 1
), done as (
  select * from onward qualify row_number() over (partition by r order by level desc) = 1
)
select l.doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, d.node as folded_root, d.node = root as verified
from leaves l join done d on l.r = d.r join tops t on l.source is not distinct from t.source,
  (select node as root from above where n = 1)
"""


def _centroids() -> str:
    rounds = "".join(
        CENTROIDS_ROUND.format(i=i) + (CENTROIDS_MOVE.format(i=i, j=i + 1) if i < 5 else "")
        for i in range(6)
    )
    return CENTROIDS_HEAD + rounds + CENTROIDS_TAIL


def _merkle() -> str:
    def field(name: str) -> str:
        text = f"cast({name} as varchar)"
        return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"

    fields = " || ".join(map(field, ("doc_id", "source", "lang", "n_chars")))
    return MERKLE.format(fields=fields, text=field("text"), lowered=field("lowered"))


def _stop_words() -> str:
    from obs_engine.llm.quality import STOP_WORDS

    words = [w for word in STOP_WORDS for w in (word, word.capitalize())]
    return ", ".join(f"'{w}'" for w in dict.fromkeys(words))


ORACLES = {
    "op4_quality": QUALITY.replace("{stop}", _stop_words()),
    "op7_exact_dedup": EXACT,
    "op11_centroids": _centroids(),
    "op12_minhash": SIMILAR_SETS,
    "op13_merkle": _merkle(),
}

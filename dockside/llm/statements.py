"""SQL that DuckDB runs on the same tables, for the operators that SQL can state; written apart from the operators."""

_KINDS = [
    ("assign", r"""((?i)password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", "len(regexp_extract(m, '{}', 2)) >= 6"),
    ("access", r"AKIA[A-Z0-9]+", "len(m) >= 20"),
    ("hex", r"[0-9a-f]+", "len(m) >= 24"),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----", "true"),
]


def _matches(rank: int, kind: str, pattern: str, good: str) -> str:
    """One row per match that counts; a match begins after the texts between and the matches before it."""
    return f"""
  select doc_id, {rank} as rank, '{kind}' as kind, s as start, s + len(m) as stop from (
    select doc_id, unnest(m) as m, unnest(list_transform(range(len(m)), lambda k:
      list_sum(list_transform(b[1:k + 1], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:k], lambda x: len(x))), 0))) as s
    from (select doc_id, regexp_extract_all(text, '{pattern}') as m, string_split_regex(text, '{pattern}') as b from texts)
  ) where {good.format(pattern)}"""


SECRETS = f"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
found as ({" union all ".join(_matches(k, *rule) for k, rule in enumerate(_KINDS))}),
grouped as (
  select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || cast(start as bigint) || ':' || cast(stop as bigint), ',' order by start, rank) filter (rank < 3) as base,
    string_agg(kind || ':' || cast(start as bigint) || ':' || cast(stop as bigint), ',' order by start, rank) as spans
  from found group by doc_id
)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join grouped g on d.doc_id = g.doc_id
"""

_STOPS = (
    "the of and to in is it that for on are as with be by this was from or an at a der die und das den von zu mit sich des auf für ist im dem "
    "nicht ein eine als auch le la les de des et un une que qui en du dans pour par sur est pas avec au el los las y del se por con para una su "
    "al lo como más no"
)

QUALITY = rf"""
with texts as (
  select doc_id, coalesce(text, '') as text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
),
windows as (
  select doc_id, i, count(*) over (partition by doc_id, g) as n from (
    select doc_id, i, array_to_string(w[i + 1:i + 5], ' ') as g
    from (select doc_id, w, unnest(range(len(w) - 4)) as i from texts where len(w) >= 5)
  )
),
repeats as (select doc_id, count(distinct i + k) as n from windows, range(5) as t(k) where n > 1 group by doc_id),
counts as (
  select t.doc_id, len(w) as n_words, len(array_to_string(w, '')) as word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols, len(regexp_replace(text, '\P{{Lu}}+', '', 'g')) as n_capitals,
    len(list_filter(w, lambda x: list_contains(string_split('{_STOPS}', ' '), lower(regexp_replace(x, '[.,;:!?]+$', ''))))) as n_stop_words,
    len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words
  from texts t left join repeats r on t.doc_id = r.doc_id
),
judged as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counts)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and n_words >= 10 and word_chars / n_words between 2 and 14 and n_symbols / n_words <= 0.2
    and n_capitals / word_chars <= 0.4 and (n_stop_words + 1) / n_words >= 0.04 and n_dup_lines / n_lines <= 0.5
    and n_repeat_words / n_words <= 0.2 as kept
from judged
"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes: each byte is mixed in, then shifted out bit by bit."""
    digits = f"hex(encode({text}))"
    steps = f"list_transform(range(0, octet_length(encode({text}))), lambda k: [cast('0x' || substr({digits}, 2 * k + 1, 2) as bigint), -1, -1, -1, -1, -1, -1, -1, -1])"
    step = "case when x >= 0 then xor(a, x) when a % 2 = 1 then xor(a >> 1, 3988292384) else a >> 1 end"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, flatten({steps})), lambda a, x: {step}), 4294967295)"


SPELLING = f"""
with recursive runs as (
  select doc_id, run, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) as run
    from documents
  ) where length(run) >= 6 group by all
),
summed as (select run, n, {_crc32("coalesce(cast(doc_id as varchar), '') || ':' || run")} as h from runs),
words as (
  select word, cast(sum(n) as bigint) as n from (
    select case when h % 199 = 0 then substr(run, 1, cast(h % length(run) as int)) || substr(run, cast(h % length(run) as int) + 2) else run end as word, n from summed
  ) where length(word) >= 6 group by word having sum(n) >= 5
),
holes as (
  select word, unnest(list_transform(range(1, length(word) + 1), lambda k: substr(word, 1, k - 1) || '_' || substr(word, k + 1))) as hole from words
),
lost as (select distinct word, replace(hole, '_', '') as shorter from holes),
near as (
  select distinct a.word, b.word as other from holes a join holes b on a.hole = b.hole and a.word <> b.word
  union select lost.word, shorter from lost join words on words.word = shorter
  union select shorter, lost.word from lost join words on words.word = shorter
),
best as (
  select near.word, count(*) as n_near, first(o.word order by o.n desc, encode(o.word)) as form, max(o.n) as form_n
  from near join words o on o.word = other group by near.word
),
judged as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when form_n >= 5 * w.n then form end as form, case when form_n >= 5 * w.n then form_n end as form_n
  from words w left join best b on w.word = b.word
),
chain as (
  select word, word as at from judged
  union all select chain.word, judged.form from chain join judged on judged.word = chain.at where judged.form is not null
),
roots as (select chain.word, chain.at as root from chain join judged on judged.word = chain.at where judged.form is null)
select j.word, j.form, r.root, j.n, j.n_near, j.form_n from judged j join roots r on j.word = r.word
"""

TRIE = f"""
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, md5(length(role) || ':' || role || text)) as pos, role, text
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)
),
convs as (
  select conv_id, conv_id - conv_id % 20 as base, {_crc32("cast(conv_id as varchar)")} % 4 as h, max(pos) as own from turns group by conv_id
),
forks as (
  select c.conv_id, c.base, c.h, least(c.h, coalesce(b.own, 0)) as taken, least(c.h, coalesce(b.own, 0)) + greatest(c.own - c.h, 0) as length
  from convs c left join convs b on c.base = b.conv_id
),
rebuilt as (
  select f.conv_id, t.pos as depth, role, text from forks f join turns t on t.conv_id = f.base and t.pos <= f.taken
  union all
  select f.conv_id, t.pos - f.h + f.taken, role, text from forks f join turns t on t.conv_id = f.conv_id and t.pos > f.h
),
keyed as (
  select conv_id, depth, text, md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '' order by depth)
    over (partition by conv_id order by depth rows unbounded preceding)) as node
  from rebuilt
  union all select conv_id, 0, '', 'root' from forks
),
linked as (select *, lag(node) over (partition by conv_id order by depth) as parent from keyed),
nodes as (
  select node, any_value(parent) as parent, any_value(depth) as depth, min(conv_id) as conv_id, count(*) as n_convs,
    len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) as words
  from linked group by node
),
children as (select parent as node, count(*) as n_children from nodes where parent is not null group by parent),
own as (
  select n.*, coalesce(n_children, 0) as n_children, case when n_children is null then 1 else 0 end as leaf, (n_convs - 1) * words as saved
  from nodes n left join children c on n.node = c.node
),
sums as (
  select k.node, sum(leaf) as n_leaves, sum(saved) as saved_tokens
  from own o join keyed k on k.conv_id = o.conv_id and k.depth <= o.depth group by k.node
),
ends as (
  select k.node, sha256(string_agg(cast(k.conv_id as varchar), ',' order by k.conv_id)) as ends
  from keyed k join forks f on f.conv_id = k.conv_id and f.length = k.depth group by k.node
)
select o.conv_id, cast(o.depth as bigint) as depth, p.conv_id as parent_conv_id, o.n_convs, cast(o.n_children as bigint) as n_children,
  cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens, coalesce(ends, sha256('')) as ends_sha256
from own o join sums s on s.node = o.node left join nodes p on p.node = o.parent left join ends e on e.node = o.node
"""

"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from paperweave.llm import chat_tokens, collocations, licenses, quality_rules as rules, vector_codes, vector_file, warc

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quality() -> str:
    stop = ", ".join(f"'{f}'" for w in rules.ALL_STOP_WORDS for f in sorted({w, w[:1].upper() + w[1:]}))
    bounds = {r.measure: r for r in rules.RULES}
    broken = ", ".join(
        f"case when {m}{f' < {r.least}' if r.least is not None else f' > {r.most}'}"
        + (f" or {m} > {r.most}" if r.least is not None and r.most is not None else "")
        + f" then '{r.name}' end" for m, r in bounds.items())
    return rf"""
with words as (select doc_id, coalesce(text, '') as t, {WORDS} as w from documents),
starts as (select doc_id, unnest(range(1, len(w) - 6)) as i from words),
windows as (select s.doc_id, i, count(*) over (partition by s.doc_id, w[i:i+7]) as n
            from starts s join words using (doc_id)),
covers as (select doc_id, i, lead(i) over (partition by doc_id order by i) as next from windows where n > 1),
repeats as (select doc_id, sum(least(8, coalesce(next - i, 8)))::bigint as n_repeat_words from covers group by all),
lines as (select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
          from words),
base as (
  select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
         len(list_filter(w, lambda x: x in ({stop}))) as n_stop, len(l) as n_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '^[ \x09-\x0D]*[-*•]'))) as n_bullet,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[ \x09-\x0D]*$'))) as n_cut
  from words join lines using (doc_id) left join repeats using (doc_id)),
ratios as (
  select *, case when n_words > 0 then word_chars::double / n_words else 0 end as mean_word_chars,
         case when n_words > 0 then n_symbols::double / n_words else 0 end as symbol_ratio,
         case when n_words > 0 then n_stop::double / n_words else 0 end as stop_ratio,
         case when n_lines > 0 then n_dup_lines::double / n_lines else 0 end as dup_line_ratio,
         case when n_lines > 0 then n_bullet::double / n_lines else 0 end as bullet_line_ratio,
         case when n_lines > 0 then n_cut::double / n_lines else 0 end as ellipsis_line_ratio
  from base),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
                  concat_ws(', ', {broken}) as broken from ratios)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
       not base_failed and broken = '' as kept, broken
from judged"""


def _licenses() -> str:
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in licenses.PHRASES.items())
    sets = []
    for i, (label, text) in enumerate(licenses.TEMPLATES):
        words = licenses.template_words(text)
        if len(words) >= licenses.LEAST_WORDS:
            sets.append(f"({i}, '{label}', [{', '.join(repr(w) for w in words)}])")
    return rf"""
with plain as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
words as (select doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w, string_split(t, chr(10)) as l
          from plain),
phrases(phrase, label, n) as (values {phrases}),
places as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from words),
hits as (select doc_id, i - 1 as start, label from places join phrases on array_to_string(w[i:i + n - 1], ' ') = phrase),
base as (select doc_id, count(*) as n, min(start) as a, max(start) as z, list(distinct label) as labels from hits group by 1),
templates(template, label, words) as (values {", ".join(sets)}),
blocks as (select doc_id, list_distinct(regexp_extract_all(unnest(l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as b from words),
met as (select doc_id, label, len(list_intersect(b, words))::double / len(words) as score
        from blocks join templates on len(list_intersect(b, words)) >= ceil({licenses.THRESHOLD} * len(words) - 1e-9)),
more as (select doc_id, list(distinct label) as labels, max(score) as score, count(*) as n from met group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(base.n, 0)::bigint as n_base, a::bigint as first_word,
       z::bigint as last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ','), '') as labels,
       case when base.n > 0 then 1.0 else coalesce(more.score, 0.0) end::double as score,
       coalesce(more.n, 0)::bigint as n_template_blocks
from words left join base using (doc_id) left join more using (doc_id)"""


VECTORS = f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor({int(vector_file.SCALE)} * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda x: coalesce(x[1] * x[2], 0)))::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= {vector_file.TOP}"""

ARCHIVES = f"""
with p as (
  select page_id, encode(coalesce(html, '')) as b from pages),
d as (select page_id, octet_length(b)::bigint as payload_bytes, sha256(b) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first from d)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= {warc.LEAST_BYTES} and page_id <> first then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= {warc.LEAST_BYTES} and page_id <> first then first end as refers_to
from f"""



def _collocations() -> str:
    longest = collocations.LONGEST
    made = "\nunion all\n".join(
        f"select lang, {k} as k, {' || chr(32) || '.join(f'w{i}' for i in range(1, k + 1))} as phrase, count(*) as a"
        f" from starts where w{k} is not null group by all" for k in range(1, longest + 1))
    following = ", ".join(f"lead(w1, {i - 1}) over place as w{i}" for i in range(2, longest + 1))
    return rf"""
with texts as (
  select coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as p from texts),
words as (select row_number() over () as piece, lang, regexp_extract_all(p, '[^\x20\x09]+') as w from pieces),
places as (select piece, lang, unnest(w) as w1, generate_subscripts(w, 1) as i from words),
starts as (select lang, w1, {following} from places window place as (partition by piece order by i)),
f as ({made}),
totals as (select lang, sum(a)::hugeint as n from f where k = 1 group by all),
frequent as (select * from f where k > 1 and a >= {collocations.LEAST}),
cuts as (
  select lang, k, phrase, a, unnest(range(1, k)) as cut, string_split(phrase, ' ') as w from frequent),
parts as (
  select c.lang, c.k, c.phrase, c.a, c.cut, x.a as l, y.a as r,
         (2000000::hugeint * c.a) // (x.a::hugeint + y.a) as score
  from cuts c join f x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.cut], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
best as (select * from parts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inner_phrases as (
  select lang, k, a as longer, unnest(list_distinct(flatten(list_transform(range(2, k), lambda m: list_transform(
    range(1, k - m + 2), lambda i: array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ')))))) as phrase
  from frequent),
gone as (select distinct f.lang, f.phrase from frequent f join inner_phrases i
         on f.lang = i.lang and f.phrase = i.phrase and 100::hugeint * i.longer >= {collocations.COVERED}::hugeint * f.a),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from best anti join gone using (lang, phrase))
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join totals using (lang) where rank <= {collocations.TOP}"""


def _vector_codes() -> str:
    parts, entries = vector_codes.PARTS, vector_codes.ENTRIES
    steps = []
    for n in range(vector_codes.ROUNDS + 1):
        steps.append(f"""d{n} as (
  select r, p, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
  from parts join book{n} using (p)),
near{n} as (select r, p, x, e, d from d{n} qualify row_number() over (partition by r, p order by d, e) = 1)""")
        if n < vector_codes.ROUNDS:
            steps.append(f"""flat{n} as (select p, e, x[i] as x, i from near{n}, unnest(range(1, len(x) + 1)) t(i)),
mean{n} as (select p, e, list(m order by i) as m from (
  select p, e, i, floor(sum(x)::decimal(38, 0) / count(*))::bigint as m from flat{n} group by all) group by all),
book{n + 1} as (select p, e, coalesce(m, c) as c from book{n} left join mean{n} using (p, e))""")
    last = vector_codes.ROUNDS
    return f"""
with kept as (
  select row_number() over (order by vec_id nulls last) as r, vec_id, label,
         list_transform(embedding, lambda x: floor({int(vector_codes.SCALE)} * x::double)::bigint) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (select r, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] as x
          from kept, unnest(range({parts})) t(p)),
book0 as (select p, r - 1 as e, x as c from parts where r <= {entries}),
{", ".join(steps)},
coded as (select r, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error from near{last} group by r),
digest as (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) as codebooks_sha256 from book{last}),
summed as (select vec_id, label, code, error, (sum(error) over (partition by label))::bigint as label_error from kept join coded using (r))
select vec_id, code, error, label_error, codebooks_sha256 from summed, digest"""


def _chat() -> str:
    controls = [c for pair in chat_tokens.ROLES.values() for c in pair] + [
        chat_tokens.OTHER, chat_tokens.BODY, chat_tokens.OTHER_END]
    either = "|".join("".join(f"\\{x}" if x in "[]/<>" else x for x in c) for c in controls)
    marks = {role: len(opening + closing) for role, (opening, closing) in chat_tokens.ROLES.items()}
    marked = " ".join(f"when '{role}' then {n}" for role, n in marks.items())
    other = len(chat_tokens.OTHER + chat_tokens.BODY + chat_tokens.OTHER_END)
    said = "</s>[INST] ok [/INST]"

    def escaped(x: str) -> str:
        return rf"length(regexp_replace(regexp_replace({x}, '(\\*)({either})', '\1\1\\\2', 'g'), '(\\+)$', '\1\1'))"

    return rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '{said}'), (-1, 1, 'assistant', '{said}'))
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
       sum({escaped("text")} + case role {marked} else {other} + {escaped("role")} end)::bigint as formatted_chars
from turns group by conv_id"""


ORACLE: dict[str, str] = {
    "op1_quality_rules": _quality(),
    "op3_licenses": _licenses(),
    "op8_vector_file": VECTORS,
    "op9_warc": ARCHIVES,
    "op11_collocations": _collocations(),
    "op12_vector_codes": _vector_codes(),
    "op13_chat_tokens": _chat(),
}

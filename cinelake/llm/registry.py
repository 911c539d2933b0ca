"""Queries of the training-data operators, and SQL for those that SQL can express.

Every query reads its whole table and returns the operator's whole result.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cinelake.llm import (bpe, chat, content_sort, decontaminate, langid, lm, prefix_trie, quality_classifier,
                          quality_rules, simhash, token_files, warc, whitening)
from cinelake.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    """The tokenizer file: ``CINELAKE_TOKENIZER``, or the public byte-level one."""
    if "CINELAKE_TOKENIZER" in os.environ:
        return os.environ["CINELAKE_TOKENIZER"]
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _bpe(spark: SparkSession, d: str) -> DataFrame:
    return bpe.digests(read(spark, d, "documents"), tokenizer_path())


def _quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.judge(read(spark, d, "documents"), read(spark, d, "labels"))


def _chat(spark: SparkSession, d: str) -> DataFrame:
    return chat.round_trip(chat.with_probe(read(spark, d, "conversations")))


def _warc(spark: SparkSession, d: str) -> DataFrame:
    return warc.round_trip(read(spark, d, "pages"))


def _quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return quality_classifier.classify(read(spark, d, "documents"), read(spark, d, "labels"))


def _token_files(spark: SparkSession, d: str) -> DataFrame:
    return token_files.round_trip(read(spark, d, "documents"), tokenizer_path(), end_id=2)


def _simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, d, "documents"), words_a_shingle=3)


def _decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.matches(read(spark, d, "documents"), read(spark, d, "benchmark"))


def _langid(spark: SparkSession, d: str) -> DataFrame:
    return langid.identify(read(spark, d, "documents"))


def _lm(spark: SparkSession, d: str) -> DataFrame:
    return lm.score(read(spark, d, "documents"))


def _content_sort(spark: SparkSession, d: str) -> DataFrame:
    return content_sort.exact_duplicates(read(spark, d, "documents"))


def _prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.trie(read(spark, d, "conversations"), block=100, heads=6)


def _whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whiten(read(spark, d, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_bpe": _bpe,
    "op2_quality_rules": _quality_rules,
    "op3_chat": _chat,
    "op4_token_files": _token_files,
    "op5_simhash": _simhash,
    "op6_warc": _warc,
    "op7_quality_classifier": _quality_classifier,
    "op8_lm": _lm,
    "op9_decontaminate": _decontaminate,
    "op10_langid": _langid,
    "op11_content_sort": _content_sort,
    "op12_prefix_trie": _prefix_trie,
    "op13_whitening": _whitening,
}

SQL: dict[str, str] = {
    # A turn takes 14 characters besides its role and body. Escapes: each ":",
    # line feed and backslash of a role; each closing string; and, where the
    # body has what reads as an escape, backslashes that stand in a row, before
    # "<" or at the end.
    "op3_chat": r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as body from conversations
  union all
  select -7, n, r, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) t(n, r)
), sized as (
  select *, 14 + length(role) + length(body)
    + length(role) - length(replace(replace(replace(role, ':', ''), chr(10), ''), '\', ''))
    + (length(body) - length(replace(body, '</turn>', ''))) // 7
    + case when regexp_matches(body, '\\[\\<]') or ends_with(body, '\')
      then list_sum(list_transform(regexp_extract_all(body, '\\+(?:<|$)|\\{2,}'),
                                   lambda m: length(replace(m, '<', '')))) else 0 end as chars
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || body || chr(10), '' order by turn nulls first, role, body)) as turns_sha256,
  cast(coalesce(sum(length(body)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(body, '' order by turn nulls first, role, body) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id""",
    "op6_warc": """
with payloads as (
  select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as hex from pages
), firsts as (
  select hex, min(page_id) as least from payloads group by hex
)
select page_id, cast(strlen(body) as bigint) as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast(1 + ((cast('0x' || substr(hex, 1 + 5 * (i // 4), 5) as bigint) >> (15 - 5 * (i % 4))) & 31) as bigint), 1)),
    '') as payload_digest,
  case when page_id = least then 'response' else 'revisit' end as record_type,
  case when page_id <> least then least end as refers_to
from payloads join firsts using (hex)""",
    "op11_content_sort": r"""
with normalised as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents
), placed as (
  select *, row_number() over (partition by body order by doc_id nulls last) as place,
    min(doc_id) over (partition by body) as keep_id, count(*) over (partition by body) as group_size
  from normalised
)
select doc_id, keep_id, group_size, place = 1 as kept, sha256(body) as text_sha256 from placed""",
    # crc32 of a conversation's digits by shifts of one bit; a node's ancestors lie on
    # the path of any of its members.
    "op12_prefix_trie": r"""
with own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as body,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
  from conversations where conv_id is not null
), convs as (
  select conv_id, conv_id - conv_id % 100 as base, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ord(x)::bigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
      lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end))) % 6 as h
  from (select distinct conv_id from own)
), turns as (
  select c.conv_id, 0 as part, o.place, o.role, o.body from convs c join own o on o.conv_id = c.base and o.place <= c.h
  union all
  select c.conv_id, 1, o.place, o.role, o.body from convs c join own o on o.conv_id = c.conv_id and o.place > c.h
), placed as (
  select conv_id, row_number() over (partition by conv_id order by part, place) as depth, role, body from turns
), visits as (
  select conv_id, depth, length(body) as chars,
    list({'r': role, 'b': body}) over (partition by conv_id order by depth) as key from placed
  union all
  select conv_id, 0, 0, [] from convs
), nodes as (
  select key, min(conv_id) as conv_id, depth, count(*) as n_convs, (count(*) - 1) * any_value(chars) as saved
  from visits group by key, depth
), parents as (
  select n.*, p.conv_id as parent_conv_id from nodes n left join nodes p on n.depth > 0 and p.key = n.key[:n.depth - 1]
), children as (
  select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n_children from parents where depth > 0 group by all
), counted as (
  select p.*, coalesce(n_children, 0) as n_children from parents p left join children using (conv_id, depth)
), sums as (
  select v.key, sum(c.saved) as saved, count(*) filter (c.n_children = 0) as n_leaves
  from counted c join visits v on v.conv_id = c.conv_id and v.depth <= c.depth group by v.key
), ends as (
  select key, string_agg(conv_id::varchar, ',' order by conv_id) as ids
  from (select conv_id, arg_max(key, depth) as key from visits group by conv_id) group by key
)
select c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved::bigint as saved_tokens,
  sha256(coalesce(e.ids, '')) as ends_sha256
from counted c join sums s using (key) left join ends e using (key)""",
}

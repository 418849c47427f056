"""Row schemas. A document is one row of ``ITEM``; everything nested hangs off it by ``stream_id``."""

from __future__ import annotations

ITEM = (
    "stream_id string, doc_id string, abs_url string, schost string, original_url string, source string, epoch_ticks double,"
    " stream_time timestamp, raw binary, encoding string, media_type string, clean_html string, clean_visible string,"
    " lang_code string, lang_name string, i_str string, pos long"
)
OTHER_CONTENT = "stream_id string, key string, media_type string, raw binary, clean_html string, clean_visible string"
RATING = "stream_id string, annotator_id string, target_id string, contains_mention boolean, relevance int, comments string, mentions array<string>, flags array<string>"
LABEL = "stream_id string, annotator_id string, target_id string, offset_type string, first long, length int, value string, content_form string, positive boolean"
TOKEN = (
    "stream_id string, tagger_id string, sentence_id int, sentence_pos int, token_num int, token string, char_first long, char_length int,"
    " byte_first long, byte_length int, entity_type string, mention_type string, equiv_id int, mention_id int"
)
TOKEN_LABEL = "stream_id string, tagger_id string, token_num int, annotator_id string, target_id string"
RELATION = "stream_id string, tagger_id string, relation_type string, sentence_id_1 int, mention_id_1 int, sentence_id_2 int, mention_id_2 int"
ATTRIBUTE = "stream_id string, tagger_id string, attribute_type string, evidence string, value string, sentence_id int, mention_id int"
POSTING = "hash int, doc_id string, epoch_ticks long, tf long"

OFFSET_TYPES = ("LINES", "BYTES", "CHARS", "XPATH_CHARS")
ENTITY_TYPES = ("PER", "ORG", "LOC", "CUSTOM_TYPE")
MENTION_TYPES = ("NAME", "PRO")
ATTRIBUTE_TYPES = ("PER_GENDER", "PER_AGE")

"""Queries of the filter audit, the conversation trie and the secret scan (11, 12, 13)."""

from __future__ import annotations

from tonalert.llm import conversation_trie, filter_audit, secret_scan
from tonalert.llm.common import table
from tonalert.llm.registry import register
from tonalert.llm.sql import AUDIT_SQL, TRIE_SQL


@register("op11_filter_audit", AUDIT_SQL)
def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op12_conversation_trie", TRIE_SQL)
def op12_conversation_trie(spark, sf_dir):
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@register("op13_secret_scan")
def op13_secret_scan(spark, sf_dir):
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))

"""Operators for preparing training data of language models.

Each takes and returns DataFrames and works over whole tables. Nothing else in the library
imports this subpackage.
"""

from clickmetrics.llm.bpe import Vocabulary, bpe_decode, bpe_encode
from clickmetrics.llm.chat import format_conversations
from clickmetrics.llm.conversation_trie import conversation_paths, prefix_trie
from clickmetrics.llm.lexical import ranked_search
from clickmetrics.llm.line_dedup import dedup_lines
from clickmetrics.llm.mixing import mix_documents, mix_plan
from clickmetrics.llm.neighbours import nearest_vectors
from clickmetrics.llm.pieces import PieceModel, piece_decode, piece_encode
from clickmetrics.llm.quality import judge_quality, keep_good
from clickmetrics.llm.secrets import find_secrets
from clickmetrics.llm.sharding import shard_documents
from clickmetrics.llm.simhash import drop_near_copies, simhash_classes
from clickmetrics.llm.token_counts import UnigramVocabulary, count_tokens

__all__ = [
    "PieceModel",
    "UnigramVocabulary",
    "Vocabulary",
    "bpe_decode",
    "bpe_encode",
    "conversation_paths",
    "count_tokens",
    "dedup_lines",
    "drop_near_copies",
    "find_secrets",
    "format_conversations",
    "judge_quality",
    "keep_good",
    "mix_documents",
    "mix_plan",
    "nearest_vectors",
    "piece_decode",
    "piece_encode",
    "prefix_trie",
    "ranked_search",
    "shard_documents",
    "simhash_classes",
]

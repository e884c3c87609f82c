"""The queries of the subpackage and their SQL."""

from feedstream.llm import (
    bpe, chat, decontaminate, lines, pages, quality, secrets, simhash, suffixes, toxicity, trie, variants, vectors)

QUERIES = {
    "op1_bpe": bpe.op1,
    "op2_secret_scan": secrets.op2,
    "op3_suffix_dedup": suffixes.op3,
    "op4_decontaminate": decontaminate.op4,
    "op5_toxicity": toxicity.op5,
    "op6_line_dedup": lines.op6,
    "op7_chat_format": chat.op7,
    "op8_quality": quality.op8,
    "op9_simhash": simhash.op9,
    "op10_embeddings": vectors.op10,
    "op11_html_extract": pages.op11,
    "op12_spelling_variants": variants.op12,
    "op13_prefix_trie": trie.op13,
}
ORACLE = {
    "op4_decontaminate": decontaminate.ORACLE_OP4,
    "op6_line_dedup": lines.ORACLE_OP6,
    "op7_chat_format": chat.ORACLE_OP7,
    "op13_prefix_trie": trie.ORACLE_OP13,
}

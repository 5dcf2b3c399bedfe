"""Training-data operators: WARC, HTML, chat, toxicity, tokens, near-duplicates, repair, search, quality.

Nothing else in the library imports this subpackage. Each module holds one
operator (``warc``, ``html_text``, ``chat``, ``toxicity``, ``token_files``,
``word_bpe``, ``embedding_dedup``, ``contamination``, ``suffix_dedup``,
``order_minhash``, ``conversation_repair``, ``lexical_search``,
``quality_classifier``); ``catalog`` registers their queries.
"""

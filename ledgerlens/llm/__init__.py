"""Training-data operators: chat formatting, embedding and text near-dedup,
toxicity, source mixing, exact search, language ID, license scans, HTML
extraction and sequence packing. Nothing outside this folder imports it."""

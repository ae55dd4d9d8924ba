"""Operations of a training-data pipeline: URL filters, mixing, quality and
toxicity classifiers, near- and substring dedup, tokenisation, quality rules."""

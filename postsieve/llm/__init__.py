"""Operations of a training-data pipeline: output, scoring, packing, deduplication, quality, mixing."""

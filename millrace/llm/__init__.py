"""Operations for training corpora of language models."""

"""Operations of a training-data pipeline: sharding, decontamination, token counts, filters, scans, dedup and mixing.

Nothing else in the library imports this subpackage.
"""

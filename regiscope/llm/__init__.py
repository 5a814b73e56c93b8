"""Operators of a training-data pipeline: identification, filtering, de-duplication, packing, binary output."""

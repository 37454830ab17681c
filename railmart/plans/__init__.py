"""Whole jobs put together from readers and operators."""

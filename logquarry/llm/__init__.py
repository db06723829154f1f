"""Operators for preparing training text: filters, near copies, decontamination, packing, search, archives."""

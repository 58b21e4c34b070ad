"""Training-data operators: deduplication, decontamination, language and quality models,
tokenisation and vector search.

Each module holds one operator; ``queries`` registers them.  Nothing else in the library imports
this subpackage.  Conventions shared by the operators: inputs are DataFrames of whole texts, only
the named columns are read (extra columns, whatever their names, are ignored), a null text counts as
empty unless a docstring says otherwise, and repeated rows give repeated results.
"""

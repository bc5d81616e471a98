"""Operations of a training-data pipeline over text corpora.

Thirteen operators, each in a module of its own, plus their registered queries
(``queries``) and DuckDB SQL (``oracle``). Nothing outside this package imports it.
"""

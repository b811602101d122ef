"""Operators: every public function is ``(DataFrame, ...) -> DataFrame``."""

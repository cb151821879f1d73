"""Generic DataFrame operators, parameterised by key, time and column names."""

"""DataFrame to DataFrame operators, parametrized by column names."""

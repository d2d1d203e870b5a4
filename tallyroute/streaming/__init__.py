"""The stateless checks and scoring over arriving files."""

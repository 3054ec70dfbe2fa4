"""Jobs composed from the operators, and the workspace they write to."""

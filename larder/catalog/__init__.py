"""The relational schema as data: columns, keys, references and rules."""

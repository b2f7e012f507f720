"""Plan shapes shared by operators, and the jobs made of them."""

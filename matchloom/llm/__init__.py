"""Training-data operators on stored pages, player profiles and dialogues."""

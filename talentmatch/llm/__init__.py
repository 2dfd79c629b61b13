"""Training-data operators: licences, archives, fingerprints, language models, personal data,
decontamination, mixing, toxicity, near duplicates, language identification, conversation repair,
prefix trees of chats and embedding whitening."""

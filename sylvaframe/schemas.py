"""Schemas of the data model, from raw pairs to grouped graphs."""

from __future__ import annotations

PAIR = "pair_id string, text string, text_b string, label string"
NODE = "struct<idx:int,word:string,lemma:string,pos:string,head:int,rel:string,morph:map<string,string>>"
NODES = f"array<{NODE}>"
GRAPH = (
    "struct<node_features:array<array<float>>,edge_features:array<array<float>>,from_idx:array<int>,to_idx:array<int>,"
    "graph_idx:array<int>,n_graphs:int,node_texts:array<struct<word:string,lemma:string>>,"
    "node_features_need_word_embs_prepended:boolean,text:string>"
)
GROUP = f"group_id string, text string, trees array<{GRAPH}>, label string, text_b string, trees_b array<{GRAPH}>"

SNLI = "sentence1 string, sentence2 string, pairID string, gold_label string"
QA = (
    "questions array<struct<questionText:string,questionType:string,answers:array<struct<answerText:string>>>>, "
    "question string, questionType string, answer string"
)

DOCUMENT_VERSION = "1.0"
